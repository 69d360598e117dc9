"""n-gram model, language identification, toxicity and secrets against plain versions."""

import collections
import hashlib
import math
import os
import random
import re
import zlib
from urllib.parse import urlparse

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from eventlytics.llm import language, ngram_lm, secrets, toxicity
from eventlytics.llm.hashstore import Store
from eventlytics.llm.queries import QUERIES

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "a b a b c"), (5, "a b a b c"), (5, "a b a b c"), (None, "b a"),
    (7, "Ab aB éÉ b"), (8, "x" * 5000), (9, "b b b a " * 200), (10, "123 456!"),
]


def odd(spark, extra=""):
    schema = "doc_id long, text string" + extra
    rows = [r + (None,) * extra.count(",") for r in ODD]
    return spark.createDataFrame(rows, schema)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def kneser_ney(train, order):
    """word tuple -> probability of its last word, from dictionaries."""
    streams = [["<s>"] * (order - 1) + t for t in train]
    grams = {order: collections.Counter(
        tuple(s[i - order + 1 : i + 1]) for s in streams for i in range(order - 1, len(s))
    )}
    for k in range(order - 1, 0, -1):
        grams[k] = collections.Counter(g[1:] for g in grams[k + 1])
    vocabulary = len({w for t in train for w in t})

    def lost(counts):
        n = collections.Counter(counts.values())
        if not all(n[i] for i in (1, 2, 3, 4)):
            return [0, 0.5, 1, 1.5]
        y = n[1] / (n[1] + 2 * n[2])
        raw = [0, 1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3]]
        return [min(max(x, 0), i) for i, x in enumerate(raw)]

    discount = {k: lost(c) for k, c in grams.items()}
    total, spare = collections.Counter(), collections.Counter()
    for k, counts in grams.items():
        for g, c in counts.items():
            total[k, g[:-1]] += c
            spare[k, g[:-1]] += discount[k][min(c, 3)]

    def p(history, word):
        out = 1 / (vocabulary + 1)
        for k in range(1, order + 1):
            context = tuple(history[len(history) - k + 1 :]) if k > 1 else ()
            if total[k, context]:
                c = grams[k][(*context, word)]
                out = (max(c - discount[k][min(c, 3)], 0) + spare[k, context] * out) / total[k, context]
        return out

    return p


@pytest.mark.parametrize("order", [1, 2, 3])
def test_ngram_scores_equal_dictionaries(spark, order):
    rng = random.Random(order)
    texts = [" ".join(rng.choice("aabbcdefgh") for _ in range(rng.randint(0, 30))) for _ in range(60)]
    train, docs = texts[:40], texts + ["zz a zz", None]
    frame = spark.createDataFrame(list(enumerate(train)), "doc_id long, text string").repartition(3)
    model = ngram_lm.fit(frame, order=order)
    got = {r.doc_id: r for r in ngram_lm.score(
        spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), model).collect()}
    p = kneser_ney([t.split() + [""] for t in train], order)
    for i, text in enumerate(docs):
        words = (text or "").split() + [""]
        history = ["<s>"] * (order - 1)
        want = 0.0
        for word in words:
            want += math.log10(p(history, word))
            history.append(word)
        assert got[i].score == pytest.approx(want, rel=1e-9)
        assert got[i].n_tokens == len(words)
    assert model.tokens == sum(len(t.split()) + 1 for t in train)


def test_op1_counts_contexts_of_two_words(spark, tmp_path):
    rng = random.Random(5)
    # the last word is told by the two before it, not by one
    lines = [f"{a} {b} {'xy'[(a + b) % 2]}" for a, b in ((rng.randrange(6), rng.randrange(6)) for _ in range(80))]
    spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["op1_ngram_lm"](spark, str(tmp_path)).collect()
    train = [t.split() + [""] for i, t in enumerate(lines) if zlib.crc32(str(i).encode()) % 5 != 1]
    p = kneser_ney(train, 3)
    assert len(out) == len(lines)
    for r in out:
        words = ["<s>", "<s>", *lines[r.doc_id].split(), ""]
        want = sum(math.log10(p(words[i - 2 : i], words[i])) for i in range(2, len(words)))
        assert r.score == pytest.approx(want, rel=1e-9)


@pytest.mark.parametrize("order", [4, 5])
def test_ngram_scores_of_longer_contexts(spark, order):
    rng = random.Random(order)
    texts = [" ".join(rng.choice("aabbcdefgh") for _ in range(rng.randint(0, 40))) for _ in range(80)]
    train, docs = texts[:50], texts + [None]
    frame = spark.createDataFrame(list(enumerate(train)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.score for r in ngram_lm.score(
        spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), ngram_lm.fit(frame, order=order)
    ).collect()}
    p = kneser_ney([t.split() + [""] for t in train], order)
    for i, text in enumerate(docs):
        words = ["<s>"] * (order - 1) + (text or "").split() + [""]
        want = sum(math.log10(p(words[j - order + 1 : j], words[j])) for j in range(order - 1, len(words)))
        assert got[i] == pytest.approx(want, rel=1e-9)


def test_ngram_disk_is_a_few_bytes_an_ngram(spark):
    rng = random.Random(7)
    # words as frequent as in prose: 1, 1/2, 1/3 ...
    words = rng.choices(range(20_000), [1 / (i + 1) for i in range(20_000)], k=300_000)
    texts = [" ".join(f"w{x}" for x in words[i : i + 1000]) for i in range(0, len(words), 1000)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2).cache()
    model = ngram_lm.fit(frame)
    distinct = model.levels[3][5]
    stored = sum(os.path.getsize(urlparse(place).path) for s in model.stores.values() for place, _ in s.files.values() if place)
    # 12 bytes a trigram, 24 a context and 12 a bigram before: 34 a trigram in all
    assert distinct > 200_000 and stored < 20 * distinct


def test_ngram_rows_of_a_task_are_a_few_bytes_an_ngram():
    rng = np.random.default_rng(3)
    words = [np.minimum(rng.zipf(1.3, 100_000), 50_000).astype(np.uint64) for _ in range(3)]
    rows = pa.Table.from_batches(list(ngram_lm._rows("gram", 3, words[0] % np.uint64(4), words, [np.ones(100_000, np.int64)])))
    assert rows["words"].nbytes + rows["counts"].nbytes < 6 * 100_000  # hashes of the words: 24 bytes
    back = []
    for shard in range(4):
        got, (n,) = ngram_lm._columns(rows.filter(pc.equal(rows["shard"], shard)))
        assert (got[0] % np.uint64(4) == shard).all() and n.sum() == len(got[0])
        back += zip(*(x.tolist() for x in got), strict=True)
    assert sorted(back) == sorted(zip(*(x.tolist() for x in words), strict=True))
    far = [x << np.uint64(40) for x in words]  # too wide for one number
    rows = pa.Table.from_batches(list(ngram_lm._rows("gram", 3, words[0] % np.uint64(4), far, [words[1]])))
    got, (n,) = ngram_lm._columns(rows.filter(pc.equal(rows["shard"], 1)))
    assert sorted(zip(got[0].tolist(), n.tolist(), strict=True)) == sorted(
        (x, y) for x, y in zip(far[0].tolist(), words[1].tolist(), strict=True) if (x >> 40) % 4 == 1
    )


def test_ngram_words_that_change_between_readings_are_told(spark):
    words = ngram_lm.Words(Store(64, 2, {}), {})
    with pytest.raises(ValueError, match="other words"):
        words.numbers(ngram_lm.hashed("a b"))


def test_ngram_probabilities_add_up(spark):
    frame = spark.createDataFrame([(1, "a b a"), (2, "b c"), (3, "c c a b")], "doc_id long, text string")
    scorer = ngram_lm.Scorer(ngram_lm.fit(frame, order=2))
    # one word each, so the first factor of each text is p(word | start)
    words = ["a", "b", "c", "never"]
    first = []
    for w in words:
        stream, sizes = ngram_lm._stream([w], 2)
        whole = scorer.scores([w])[3][0]
        end = math.log10(_conditional(scorer, stream[1], stream[2]))
        first.append(10 ** (whole - end))
    end_first = 10 ** scorer.scores([""])[3][0]
    assert sum(first) + end_first == pytest.approx(1.0)


def _conditional(scorer, context, word):
    context, word = np.array([context]), np.array([word])
    model = scorer.model
    raw = scorer.readers["gram", 1].find(word)[:, 0].astype(np.int64)
    total, n1, n2, _, _, types = model.levels[1]
    p = scorer._left(raw, 1) / total + scorer.lost[1][1:] @ [n1, n2, types - n1 - n2] / total / (model.distinct + 1)
    known = scorer.readers["context", 2].find(context).astype(np.int64)
    if known[0, 0]:
        count = scorer.readers["gram", 2].find(ngram_lm.mix(context, word))[:, 0].astype(np.int64)
        p = scorer._left(count, 2) / known[0, 0] + (known[0, 1:] @ scorer.lost[2][1:]) / known[0, 0] * p
    return float(p[0])


def test_ngram_odd_rows_and_empty_tables(spark):
    model = ngram_lm.fit(odd(spark, ", score string"))
    out = ngram_lm.score(odd(spark, ", score string"), model).collect()
    assert len(out) == len(ODD) and all(math.isfinite(r.score) and r.score <= 0 for r in out)
    assert {r.n_tokens for r in out if r.doc_id in (1, 2, 3)} == {1}
    none = odd(spark).limit(0)
    assert ngram_lm.score(none, model).count() == 0
    untrained = ngram_lm.fit(none)
    assert {r.score for r in ngram_lm.score(odd(spark), untrained).collect()} == {0.0}


def test_op1_base_scores(spark, small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    tokens = {i: re.findall(r"[^\x20\x09-\x0D]+", lower(t or "")) + [None] for i, t in docs.items()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in docs}
    count = collections.Counter(w for i, t in tokens.items() if not held[i] for w in t)
    total = sum(count.values())
    out = QUERIES["op1_ngram_lm"](spark, small).collect()
    assert len(out) == len(docs)
    for r in out:
        own = tokens[r.doc_id]
        base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (len(count) + 1))) for w in own)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(own), total)
        assert r.n_known == sum(count[w] > 0 for w in own) and r.base_score == pytest.approx(base)
    out = [r for r in out if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def ppm_cost(texts, order=3):
    seen = collections.defaultdict(collections.Counter)
    for t in texts:
        b = b"\n" * order + t.encode()
        for i in range(order, len(b)):
            for k in range(order + 1):
                seen[b[i - k : i]][b[i]] += 1

    def cost(text):
        b, bits = b"\n" * order + text.encode(), 0.0
        for i in range(order, len(b)):
            out, paid = set(), 0.0
            for k in range(order, -1, -1):
                c = {x: n for x, n in seen.get(b[i - k : i], {}).items() if x not in out}
                if not c:
                    continue
                total = sum(c.values()) + len(c)
                if b[i] in c:
                    bits += paid - math.log2(c[b[i]] / total)
                    break
                paid -= math.log2(len(c) / total)
                out |= set(c)
            else:
                bits += paid + math.log2(256 - len(out))
        return bits

    return cost


def test_ppm_code_lengths_equal_dictionaries():
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcdé \n") for _ in range(rng.randint(0, 60))) for _ in range(20)]
    tree = language.Tree(*np.unique(language._grams(texts), return_counts=True))
    cost = ppm_cost(texts)
    for text in [*texts[:5], "", "zzz", "abzéq", "a" * 50]:
        data = b"\n\n\n" + text.encode()
        got = tree.bits(np.frombuffer(data, np.uint8), np.array([len(data)]))[0]
        assert got == pytest.approx(cost(text), rel=1e-5, abs=1e-6)


def test_language_rows_and_ties(spark):
    rows = [(1, "the cat sat on the mat", "en"), (2, "der hund und die katze", "de"), (3, None, "en"), (4, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert model.languages == ["de", "en"]
    got = {r.doc_id: r for r in language.predict(
        spark.createDataFrame([(1, "the mat", 9), (2, "und der", 9), (3, None, 9), (4, "12 34!", 9), (5, "", 9)],
                              "doc_id long, text string, score int"), model).collect()}
    assert [got[i].lang_pred for i in range(1, 6)] == ["en", "de", "und", "und", "und"]
    assert all(0 <= r.score <= 1 for r in got.values()) and got[3].score == 0
    none = language.fit(docs.limit(0))
    assert {r.lang_pred for r in language.predict(docs, none).collect()} == {"und"}
    kept = language.keep_known(docs, model)
    assert kept.schema == docs.schema and sorted(r.doc_id for r in kept.collect()) == [1, 2, 4]


def test_strange_texts_go(spark):
    rng = random.Random(8)
    tongues = {x: ["".join(rng.choice(c) + rng.choice(v) for _ in range(rng.randint(1, 3))) for _ in range(150)]
               for x, c, v in (("a", "bdfklmnt", "aeio"), ("b", "prstvzgh", "eiou"), ("c", "wjqxyckm", "auyö"))}
    speak = lambda x, n: " ".join(rng.choice(tongues[x]) for _ in range(n))
    learned = [(i, speak("ab"[i % 2], rng.randint(5, 120)), "ab"[i % 2]) for i in range(300)]
    model = language.fit(spark.createDataFrame(learned, "doc_id long, text string, lang string").repartition(3), spread=True)
    clean = [(i, speak("ab"[i % 2], rng.randint(1, 150))) for i in range(200)]
    other = [(1000 + i, speak("c", 60)) for i in range(20)]
    noise = [(2000 + i, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(200))) for i in range(20)]
    docs = spark.createDataFrame(clean + other + noise, "doc_id long, text string")
    assert sorted(r.doc_id for r in language.keep_known(docs, model).collect()) == list(range(200))
    assert {r.lang_pred for r in language.predict(docs, model).collect()} == {"a", "b"}


def test_op2_held_out_accuracy(spark, small):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    out = [r for r in QUERIES["op2_language"](spark, small).collect() if r.held_out]
    assert out and sum(truth[r.doc_id] == r.lang_pred for r in out) >= 0.95 * len(out)


def test_secret_base_spans(spark):
    pattern = re.compile(
        r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    )
    rng = random.Random(2)
    pieces = ["token", "PassWord", "api_key", "apikey", "secret", "=", ":", " ", '"', "'", "AKIA", "abcdef0123456789",
              "ABCDEFGHIJKLMN", "0" * 16, "x", "ſ", "K", "é", "aaaaaaaaaaaa", "\n"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))) for _ in range(400)] + ["", None]
    out = secrets.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), VOCABULARY).collect()
    for row in out:
        text = texts[row.doc_id] or ""
        want = [(m.start(), 0, m.end()) for m in pattern.finditer(text) if len(m[2]) >= 12]
        want += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
        want += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
        got = [(s.start, secrets.KINDS.index(s.kind), s.end) for s in row.spans if s.kind != "random"]
        assert got == sorted(want)


def test_random_strings_and_their_exceptions():
    scanner = secrets.Scanner(VOCABULARY)
    kinds = lambda text: [k for _, k, _ in scanner.spans(text)]
    assert kinds("key is Zq8Lw3Xv9Tb2Rk7Pm4Nc6Hd1 today") == ["random"]
    for fine in (hashlib.md5(b"x").hexdigest().upper(), "550E8400-E29B-41D4-A716-446655440000",
                 "release-candidate-2024-01-02", "A_VERY_LONG_IDENTIFIER_NAME_OF_2024", "4785380592391139999999",
                 "thereionationthereionation"):
        assert "random" not in kinds(f"see {fine} here")


def test_random_keys_behind_readable_parts():
    scanner, rng = secrets.Scanner(VOCABULARY), random.Random(3)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

    def missed(before, alphabet, size, after=""):
        lost = 0
        for _ in range(200):
            key = "".join(rng.choice(alphabet) for _ in range(size))
            lost += key in secrets.blanked(f"see {before}{key}{after} now", scanner.spans(f"see {before}{key}{after} now"), "#")
        return lost

    for before in ("", "api/download/", "documentation/reference/configuration/", "my-long-dashed-name-of-a-"):
        assert missed(before, letters + "0123456789", 20, "/index") <= 14
        assert missed(before, letters + "0123456789", 40) <= 2
        assert missed(before, letters, 40) <= 10
    for fine in ("documentation/reference/configuration/index", "internationalization", "documentation/reference/configuration/internationalization/550e8400-e29b-41d4-a716-446655440000/edit",
                 "documentation/reference/configuration/internationalization/how-to-do-it-in-c3-or-b2", f"documentation/reference/configuration/internationalization/{hashlib.md5(b'y').hexdigest().upper()}/download",
                 "getElementsByClassNameAndAttribute"):
        assert not [k for _, k, _ in scanner.spans(fine) if k == "random"], fine
    key = "Zq8Lw3Xv9Tb2Rk7Pm" + "0123456789abcdef" + "Nc6Hd1Jy5Gs4Qf0We"  # digits only before the hex part
    spans = scanner.spans(f"x {key} y")
    assert {k for _, k, _ in spans} == {"hex", "random"} and secrets.blanked(f"x {key} y", spans, "") == "x  y"


def test_redaction_keeps_rows_and_columns(spark):
    rows = [(1, "token = abcdefghijklmnop end", None), (2, None, "x"), (3, "clean text", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    out = secrets.redact(docs, VOCABULARY)
    assert out.schema == docs.schema
    assert {r.doc_id: r.text for r in out.collect()} == {1: "<secret> end", 2: None, 3: "clean text"}
    assert secrets.scan(docs.limit(0), VOCABULARY).count() == 0


def test_op4_digests(spark, small):
    for r in QUERIES["op4_secrets"](spark, small).collect():
        base = ",".join(s for s in r.spans.split(",") if s and not s.startswith("random"))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert r.n_assign + r.n_access + r.n_hex == (base.count(",") + 1 if base else 0)


def test_toxicity_learns_subwords(spark):
    rng = random.Random(3)
    plain = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(200)]
    bad = ["zorgling", "zorglift", "zorglump", "zorglent"]
    texts, labels = [], []
    for i in range(240):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 120))]
        if i % 3 == 0:
            words[rng.randrange(len(words))] = rng.choice(bad)
        texts.append(" ".join(words))
        labels.append(int(i % 3 == 0))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    marks = spark.createDataFrame([(i, y, 1.0) for i, y in enumerate(labels)] + [(0, None, 0.0), (999, 1, 0.0)],
                                  "doc_id long, toxic int, score double")
    model = toxicity.fit(docs, marks)
    asked = [(1, f"{plain[0]} zorglimp {plain[1]}"), (2, " ".join(plain[:40])), (3, None), (4, ""), (None, "!?")]
    got = {r.doc_id: r.score for r in toxicity.score(
        spark.createDataFrame(asked, "doc_id long, text string"), model).collect()}
    assert got[1] > 0.5 > got[2] and got[3] == got[4] == got[None] and all(0 <= x <= 1 for x in got.values())
    nothing = toxicity.fit(docs, marks.limit(0))
    assert toxicity.score(docs, nothing).count() == len(texts)


def test_worst_passage():
    rng = np.random.default_rng(1)
    scores = rng.normal(size=100)
    mean, at = toxicity.worst(scores, 24)
    assert mean == pytest.approx(max(scores[i : i + 24].mean() for i in range(77)))
    assert scores[at : at + 24].mean() == pytest.approx(mean)
    assert toxicity.worst(scores[:5], 24) == (pytest.approx(scores[:5].mean()), 0)


def test_op6_separates_the_classes(spark, small):
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    out = QUERIES["op6_toxicity"](spark, small).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    own = [r for r in out if r.doc_id in toxic and not r.held_out]
    one = [r.score for r in own if toxic[r.doc_id]]
    zero = [r.score for r in own if not toxic[r.doc_id]]
    assert sum(a > b for a in one for b in zero) > 0.95 * len(one) * len(zero)
