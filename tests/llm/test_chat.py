"""Chat formatting, fill-in-the-middle and conversation repair against plain versions."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eventlytics.llm import chat, chat_repair, fill_middle
from eventlytics.llm.chat_repair import Repairer
from eventlytics.llm.marks import check_marks
from eventlytics.llm.queries import ORACLES, QUERIES

TURNS = "conv_id long, turn long, role string, text string"
BITS = ["[INST]", "[/INST]", "[\\INST]", "[\\\\INST]", "</s>", "<s>", "<\\s>", "[NEXT]", "[ROLE]", "[/ROLE]", "[/TURN]",
        "[", "]", "<", "INST]", "/s>", "\\", "$1", "é", "\U0001f642", "\n", " ", "a", "[SYSTEM_PROMPT]", "[/SYSTEM_PROMPT]"]
ROLES = ["system", "user", "assistant", "tool", "", "[/ROLE]", "a\nb", None]


def chat_rows(n, seed):
    rng = random.Random(seed)

    def text():
        return "".join(rng.choice(BITS) for _ in range(rng.randint(0, 8)))

    return [
        (conv, turn, rng.choice(ROLES), rng.choice([text(), text(), None, ""]))
        for conv in range(n) for turn in range(rng.randint(1, 9))
    ]


def in_order(rows):
    """Rows of every conversation by (turn, role, text), nulls first; then (role, text) with nulls empty."""
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    return {conv: [r[1:] for r in sorted(turns)] for conv, turns in by.items()}


def formatted(df, template=chat.Template()):
    out = chat.format_chats(df, template)
    return {
        r[0]: r[1:] for r in out.select(
            "conv_id", "formatted", chat.read_back(F.col("formatted"), template),
            chat.loss_text(F.col("pieces"), template),
        ).collect()
    }


def test_chats_are_read_back(spark):
    rows = chat_rows(60, 1)
    got = formatted(spark.createDataFrame(rows, TURNS))
    for conv, turns in in_order(rows).items():
        text, back, loss = got[conv]
        assert [tuple(t) for t in back] == turns
        assert loss == "".join(t for r, t in turns if r == "assistant")
        runs = [r for r, _ in itertools.groupby(turns, key=lambda t: t[0])]
        assert text.count("[NEXT]") == len(turns) - len(runs)
        assert text.count("[INST]") == text.count("[/INST]") == runs.count("user")
        assert text.count("</s>") == runs.count("assistant")


def test_chat_format_itself(spark):
    rows = [(1, 1, "user", "b"), (1, 0, "system", "a[INST]"), (1, 1, "user", None), (1, 2, "assistant", "x[\\INST]"),
            (2, None, "assistant", ""), (None, 1, "tool", "q")]
    got = formatted(spark.createDataFrame(rows, TURNS))
    assert {k: v[0] for k, v in got.items()} == {
        1: "<s>[SYSTEM_PROMPT]a[\\INST][/SYSTEM_PROMPT][INST][NEXT]b[/INST]x[\\\\INST]</s>",
        2: "<s></s>", None: "<s>[ROLE]tool[/ROLE]q[/TURN]",
    }


def test_other_templates(spark):
    own = chat.Template(
        begin="<|bos|>", roles={"user": ("<|user|>", "<|end|>"), "bot": ("<|bot|>", "<|eot|>")},
        other=("<|role|>", "<|says|>", "<|done|>"), between="<|and|>", trained=("bot", "tool"),
    )
    rows = [(1, 0, "user", "<|end|>"), (1, 1, "bot", "a"), (1, 2, "bot", "<\\|and|>"), (1, 3, "tool", "t<|")]
    text, back, loss = formatted(spark.createDataFrame(rows, TURNS), own)[1]
    assert text == "<|bos|><|user|><\\|end|><|end|><|bot|>a<|and|><\\\\|and|><|eot|><|role|>tool<|says|>t<|<|done|>"
    assert [tuple(t) for t in back] == [r[2:] for r in rows] and loss == "a<\\|and|>t<|"
    for bad in (dict(begin="[INST]"), dict(between="x<"), dict(begin="<s\\>"), dict(between="ST]["),
                dict(roles={"a": ("", "</a>"), "b": ("", "</b>")})):
        with pytest.raises(ValueError):
            chat.Template(**bad)
    with pytest.raises(ValueError):
        check_marks(["ab", "ba"])


def test_chat_odd_rows(spark):
    rows = [(1, 0, "user", "é" * 2_000_000), (1, 0, "user", "é" * 2_000_000), (1, 1, "assistant", "[INST]" * 50_000)]
    odd = spark.createDataFrame(rows, TURNS).select("*", *[F.lit(1).alias(c) for c in ("turns", "starts", "pieces", "formatted")])
    text, back, loss = formatted(odd)[1]
    assert [tuple(t) for t in back] == [r[2:] for r in rows] and loss == rows[2][3]
    assert formatted(spark.createDataFrame([], TURNS)) == {}


def test_chat_long_conversation(spark):
    """Work grows with the turns, not with their square."""
    rows = spark.range(60_000).selectExpr(
        "1L AS conv_id", "id AS turn", "IF(id % 3 = 0, 'user', 'assistant') AS role", "concat('text ', id) AS text")
    out = chat.format_chats(rows)
    got = out.select(F.size(chat.read_back(F.col("formatted"))), F.length(chat.loss_text(F.col("pieces")))).collect()
    assert tuple(got[0]) == (60_000, sum(len(f"text {i}") for i in range(60_000) if i % 3))


def test_op11_stays_in_the_engine(spark, small):
    plan = QUERIES["op11_chat_format"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def fill_brute(doc_id, text, unit="character", seed="1:"):
    text = text or ""
    digest = hashlib.sha256((seed + ("" if doc_id is None else str(doc_id))).encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = {"character": list(text), "line": re.findall(r"[^\n]*\n|[^\n]+", text),
             "word": re.findall(r"^[ \t\n\v\f\r]+|[^ \t\n\v\f\r]+[ \t\n\v\f\r]*", text)}[unit]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return (doc_id, n, "plain", None, None, text)
    if h[3] % 100 < 20:
        return (doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def docs(n, seed):
    rng = random.Random(seed)
    bits = ["a", "word", " ", "  ", "\n", "\t", "é", "世界", "\U0001f642", "<P", ">", "<S>", "\x00", "é"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.choice([0, 1, 5, 40])))) for i in range(n)]
    return [*rows, (None, "null id"), (n, None), (n, "again"), (n, "again"), (-5, "minus")]


@pytest.mark.parametrize("unit", fill_middle.UNITS)
def test_fill_in_middle(spark, unit):
    rows = docs(300, 2)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("h1", F.lit(0)).withColumn("form", F.lit("x"))
    made = fill_middle.fill_in_middle(df, unit=unit)
    got = made.withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    want = [fill_brute(*r, unit) for r in rows]
    key = str
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted(want, key=key)
    assert sorted(r["back"] for r in got) == sorted(t or "" for _, t in rows)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("unit", fill_middle.UNITS)
def test_texts_in_many_parts(monkeypatch, unit):
    rows = docs(120, 3)
    texts = pa.array(["skipped", *[t or "" for _, t in rows]]).slice(1)
    rng = np.random.default_rng(4)
    draws = [rng.integers(0, 1 << 32, len(rows)) for _ in range(4)]
    whole = [c.to_pylist() for c in fill_middle.transform(texts, draws, unit)]
    for size in (1, 3, 7):
        monkeypatch.setattr(fill_middle, "PART_BYTES", size)
        assert [c.to_pylist() for c in fill_middle.transform(texts, draws, unit)] == whole


def test_fill_long_and_empty_tables(spark):
    rows = [(3, "é" * 3_000_000), (4, " " * 2_000_000), (5, "x" * 1_000_001)]
    made = fill_middle.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, made.collect())) == sorted(fill_brute(*r) for r in rows)
    none = fill_middle.fill_in_middle(spark.createDataFrame([], "doc_id long, text string"))
    assert none.collect() == []
    with pytest.raises(ValueError):
        fill_middle.fill_in_middle(none, text_col="output", marks=("<P>", "<P>x", "<M>"))


SYMBOLS = [(i, t) for i in ("s", "u", "a", "") for t in (False, True)] + [("D", False)]
GOES_ON = {"": "su", "s": "u", "u": "a", "a": "u"}


def repair_brute(symbols):
    """Least (cost, audit) over every sequence of edits with up to two insertions at a place."""
    best = {"": (0, "")}

    def offer(table, state, value):
        if state not in table or value < table[state]:
            table[state] = value

    def inserted(states):
        out = dict(states)
        for _ in range(3):
            for state, (cost, audit) in list(out.items()):
                for role in set(GOES_ON[state]) - {"s"}:
                    offer(out, role, (cost + 3, audit + "I"))
        return out

    for initial, truncated in symbols:
        new = {}
        for state, (cost, audit) in inserted(best).items():
            offer(new, state, (cost + 4, audit + "D"))
            if initial == "D":
                continue
            more = 3 * truncated
            for role in GOES_ON[state]:
                if role == initial:
                    offer(new, role, (cost + more, audit + "K"))
                if role != "s":
                    offer(new, role, (cost + 3 + more, audit + "R"))
        best = new
    return min(v for k, v in inserted(best).items() if k in ("", "a"))


def runs(symbols):
    return [(k, sum(1 for _ in g)) for k, g in itertools.groupby(symbols)]


def test_repairs_are_cheapest():
    repairer, rng = Repairer(), random.Random(5)
    short = itertools.chain.from_iterable(itertools.product(SYMBOLS, repeat=n) for n in range(4))
    long = [[rng.choice(SYMBOLS) for _ in range(rng.randint(4, 30))] for _ in range(300)]
    runny = [[s for _ in range(4) for s in [rng.choice(SYMBOLS)] * rng.choice([1, 5, 300, 700])] for _ in range(20)]
    for symbols in [*short, *long, *runny]:
        assert repairer.solve(runs(symbols)) == repair_brute(symbols)


def test_a_run_of_millions():
    cost, audit = Repairer().solve([(("u", False), 1_000_000)])
    assert cost == 1_500_000 and len(audit) == 1_000_000 and set(audit) == {"K", "R"}


def repaired(df, **options):
    return {r["conv_id"]: r.asDict() for r in chat_repair.repair(df, **options).collect()}


def test_repair_by_hand(spark):
    rows = [
        (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes!"),
        (2, 0, "user", "Hi."), (2, 0, "user", "Hi."), (2, 5, "assistant", "cut"), (2, 7, None, None),
        (3, None, "assistant", "x."), (3, 1, "system", " "), (None, 1, "user", "q?"),
    ]
    df = spark.createDataFrame(rows, TURNS).withColumn("gone", F.lit(7)).withColumn("cost", F.lit(1))
    got = repaired(df)
    nothing = {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0}
    assert got[1] == {"conv_id": 1, **nothing, "audit": "KK", "turns": [("user", "Hi."), ("assistant", "Yes!")]}
    assert got[2] == {"conv_id": 2, **nothing, "gaps": 5, "blank": 1, "duplicate": 1, "truncated": 1, "illegal": 2,
                      "cost": 11, "audit": "KDKD", "turns": [("user", "Hi."), ("assistant", "cut")]}
    assert got[3]["audit"] == "IKD" and got[3]["turns"] == [("user", ""), ("assistant", "x.")]
    assert got[None]["audit"] == "KI" and got[None]["turns"] == [("user", "q?"), ("assistant", "")]
    assert repaired(spark.createDataFrame([], TURNS)) == {}


def test_conversations_without_rows_and_damage(spark):
    def kind(conv, turn):
        return zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20

    rows = [(c, t, "assistant", "A. b!") for c in [*range(40), None] for t in (0, 1, None)]
    df = spark.createDataFrame(rows, TURNS)
    got = sorted(map(str, chat_repair.damaged(df).collect()))
    want = []
    for conv, turn, role, text in rows:
        k = kind(conv, turn)
        row = (conv, turn, "user" if k == 4 else role, {1: "", 2: "A b"}.get(k, text), k == 0)
        want += [row] * (2 if k == 3 else 1)
    names = ("conv_id", "turn", "role", "text", "gone")
    assert got == sorted("Row(" + ", ".join(f"{n}={v!r}" for n, v in zip(names, r)) + ")" for r in want)
    gone = spark.createDataFrame([(9, 0, "user", "x", True), (9, 1, None, None, True)], TURNS + ", gone boolean")
    assert repaired(gone, gone_col="gone")[9] == {
        "conv_id": 9, "gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "", "turns": []}


def test_long_conversation_is_repaired(spark):
    rows = spark.range(5_000).selectExpr(
        "1L AS conv_id", "id AS turn", "IF(id < 3000, 'user', 'assistant') AS role", "concat('text ', id, '.') AS text")
    got = repaired(rows)[1]
    assert (got["cost"], got["audit"]) == repair_brute([("u", False)] * 3_000 + [("a", False)] * 2_000)


@pytest.mark.parametrize("name", ["op11_chat_format", "op12_fill_middle", "op13_chat_repair"])
def test_odd_tables_equal_their_sql(spark, tmp_path, name):
    """Nulls in every column, ties, repeated rows, extra columns."""
    rng = random.Random(6)
    texts = [None, "", " ", "Hello.", "Hi", "<P>", "[INST] é </s>", "What?\n", "　", "no end \t"]
    turns = [
        (rng.choice([None, *range(12)]), rng.choice([None, 0, 1, 2, 3, 9]), rng.choice(["user", "assistant", "system", "tool", "", None]),
         rng.choice(texts), "x") for _ in range(160)
    ]
    many = [(rng.choice([None, *range(30)]), rng.choice(texts), 1) for _ in range(80)]
    spark.createDataFrame(turns, TURNS + ", audit string").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    spark.createDataFrame(many, "doc_id long, text string, n int").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    for table in ("conversations", "documents"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    result = QUERIES[name](spark, str(tmp_path))
    right = con.sql(f"SELECT {', '.join(result.columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(str, map(tuple, result.collect()))) == sorted(map(str, right))
