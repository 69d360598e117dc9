"""Choosing contests for many cards at once.

Candidates are rows (card, fight_id, name1, name2, win_rate1/2, finish_rate1/2,
total_fights1/2, weight_class, is_title). All cards advance together; a card
may have any number of candidates, since only its chosen contests (at most
``MAX_FIGHTS``) and its ``AT_ONCE`` best candidates are ever gathered in one row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from eventlytics.operators.scale import broadcast_checked, keep_first_n, shared_checkpoint

# Limits of a card and weights of the score and the estimate.
MIN_FIGHTS, MAX_FIGHTS, MIN_CLASSES = 10, 14, 3
MISSING = {"win_rate": 0.5, "total_fights": 0, "finish_rate": 0.3}
WIN_WEIGHT, EXPERIENCE_WEIGHT, FINISH_WEIGHT = 0.2, 0.15, 0.15
TITLE_BONUS, CLOSE_WEIGHT, NEW_CLASS_BONUS = 0.3, 0.1, 0.1
FULL_EXPERIENCE = 20
ESTIMATE_BASE, ESTIMATE_SCALE, ESTIMATE_CAP, ESTIMATE_TITLE = 0.75, 15, 0.25, 0.02
ESTIMATE_LOW, ESTIMATE_HIGH = 0.5, 1.0
SMALLEST_GAIN = 0.001
ROUNDING = 1e-9  # a bound leaves out nothing that rounding might let in
AT_ONCE = 200  # candidates of a card walked in one row
FEW_CARDS = 20_000  # rows of whole cards, a few kilobytes each, that are broadcast


def base_score() -> Column:
    """Draw of a contest without the bonus for a class new to the card."""

    def side(name: str, i: int) -> Column:
        return F.coalesce(f"{name}{i}", F.lit(MISSING[name]))

    def both(name: str) -> Column:
        return side(name, 1) + side(name, 2)

    def seasoned(i: int) -> Column:
        return F.least(side("total_fights", i) / FULL_EXPERIENCE, F.lit(1.0))

    gap = F.abs(side("win_rate", 1) - side("win_rate", 2))
    return (
        both("win_rate") * WIN_WEIGHT
        + (seasoned(1) + seasoned(2)) * EXPERIENCE_WEIGHT
        + both("finish_rate") * FINISH_WEIGHT
        + F.when(F.col("is_title"), TITLE_BONUS).otherwise(0.0)
        + (1 - gap) * CLOSE_WEIGHT
    )


def score_candidates(candidates: DataFrame) -> DataFrame:
    """Add ``base`` and ``score``; on an empty card every class is new."""
    return candidates.withColumn("base", base_score()).withColumn(
        "score", F.col("base") + NEW_CLASS_BONUS
    )


def greedy_cards(scored: DataFrame, max_fights: int = MAX_FIGHTS, at_once: int = AT_ONCE) -> DataFrame:
    """Best contests first, no entity twice, at most ``max_fights`` per card.

    Equals taking contests one by one by (score desc, fight_id). The ``at_once`` best
    candidates of a card are cut in every map task before the shuffle and walked in one
    row. A card that is still short goes on behind them with the candidates whose names
    are free, of which the best is always taken: ``max_fights`` goes are enough, and
    most cards need one. Rows of one fight_id are one contest, but each takes a place.
    """
    at_once = max(at_once, max_fights)
    left = scored.filter(F.col("card").isNotNull() & F.col("fight_id").isNotNull()).select(
        "card", (-F.col("score")).alias("s"), F.col("fight_id").alias("f"), "name1", "name2"
    )
    near, ended = left, []
    kinds = {"ids": scored.schema["fight_id"].dataType, "names": scored.schema["name1"].dataType}
    for go in range(max_fights):
        best = keep_first_n(near, ["card"], ["s", "f"], at_once).groupBy("card").agg(
            F.sort_array(F.collect_list(F.struct("s", "f", "name1", "name2"))).alias("rows")
        )
        if go == 0:
            start = F.struct(*[F.array().cast(ArrayType(t)).alias(c) for c, t in kinds.items()], F.lit(0).alias("n"))
        else:
            best, start = best.join(short.select("card", "state"), "card"), F.col("state")
        cut, last = F.size("rows") == at_once, F.element_at("rows", -1)

        def is_last(r: Column) -> Column:
            return r["s"].eqNullSafe(last["s"]) & (r["f"] == last["f"])

        # copies of the last row may lie behind the cut: they are left to the next go
        whole = F.when(cut & ~is_last(F.get("rows", 0)), F.filter("rows", lambda r: ~is_last(r))).otherwise(F.col("rows"))
        walked = shared_checkpoint(best.select(
            "card", F.aggregate(whole, start, lambda state, r: _take(state, r, max_fights)).alias("state"),
            F.struct(last["s"].alias("s"), last["f"].alias("f")).alias("last"), cut.alias("cut"),
        ))
        goes_on = F.col("cut") & (F.col("state.n") < max_fights)
        ended.append(walked.filter(~goes_on))
        short = walked.filter(goes_on)
        if short.isEmpty():
            break
        short = broadcast_checked(short, FEW_CARDS)
        free = ~(_has("state.names", F.col("name1")) | _has("state.names", F.col("name2")))
        near = left.join(short, "card").filter(
            (F.struct("s", "f") >= F.col("last")) & (free | _has("state.ids", F.col("f")))
        ).select(left.columns)
    chosen = reduce(DataFrame.unionByName, ended).select("card", F.explode("state.ids").alias("fight_id"))
    return scored.join(broadcast_checked(chosen), ["card", "fight_id"], "left_semi")


def _has(values: str | Column, value: Column) -> Column:
    """Whether a list holds a value; null is in none."""
    return F.coalesce(F.array_contains(values, value), F.lit(False))


def _take(state: Column, row: Column, max_fights: int) -> Column:
    """The contests and names of a card after one more candidate."""
    known = F.array_contains(state["ids"], row["f"])
    blocked = _has(state["names"], row["name1"]) | _has(state["names"], row["name2"])
    more = F.struct(
        F.when(known, state["ids"]).otherwise(F.concat(state["ids"], F.array(row["f"]))).alias("ids"),
        F.when(known, state["names"]).otherwise(F.concat(state["names"], F.array(row["name1"], row["name2"]))).alias("names"),
        (state["n"] + 1).alias("n"),
    )
    return F.when((state["n"] >= max_fights) | (~known & blocked), state).otherwise(more)


def estimate(total: Column, titles: Column) -> Column:
    """Share of seats sold from the summed scores and the title contests."""
    value = (
        F.lit(ESTIMATE_BASE)
        + F.least(total / ESTIMATE_SCALE, F.lit(ESTIMATE_CAP))
        + titles * ESTIMATE_TITLE
    )
    return F.greatest(F.lit(ESTIMATE_LOW), F.least(F.lit(ESTIMATE_HIGH), value))


def card_estimates(cards: DataFrame, chosen: DataFrame, capacity: int = 20_000) -> DataFrame:
    """Estimate and attendance per card; a card without contests gets the floor."""
    sums = chosen.groupBy("card").agg(
        F.count("*").alias("num_fights"),
        F.sum("score").alias("total_score"),
        F.sum(F.col("is_title").cast("int")).alias("num_titles"),
    )
    share = F.when(
        F.col("num_fights").isNotNull(), estimate(F.col("total_score"), F.col("num_titles"))
    ).otherwise(ESTIMATE_LOW)
    return (
        cards.select("card").distinct().join(sums, "card", "left")
        .withColumn("sell_through", share)
        .withColumn("attendance", F.floor(F.col("sell_through") * capacity))
        .select("card", F.coalesce("num_fights", F.lit(0)).alias("num_fights"),
                "sell_through", "attendance")
    )


def card_validity(
    chosen: DataFrame, low: int = MIN_FIGHTS, high: int = MAX_FIGHTS, classes: int = MIN_CLASSES
) -> DataFrame:
    """Size, number of classes and whether an entity appears twice, per card."""
    sizes = chosen.groupBy("card").agg(
        F.count("*").alias("num_fights"), F.countDistinct("weight_class").alias("num_classes")
    )
    names = chosen.select("card", F.explode(F.array("name1", "name2")).alias("name"))
    repeats = (
        names.groupBy("card", "name").agg(F.count("*").alias("n"))
        .groupBy("card").agg((F.max("n") > 1).alias("has_repeat"))
    )
    fits = F.col("num_fights").between(low, high) & (F.col("num_classes") >= classes)
    return sizes.join(repeats, "card").withColumn("is_valid", fits & ~F.col("has_repeat"))


def improve_cards(
    scored: DataFrame,
    chosen: DataFrame,
    max_rounds: int = 100,
    low: int = MIN_FIGHTS,
    high: int = MAX_FIGHTS,
    classes: int = MIN_CLASSES,
) -> DataFrame:
    """Swap one contest per card and round while the estimate rises.

    A card takes the first improving swap by (position on the card, fight_id of
    the newcomer). The newcomer is scored against the card without the contest
    it replaces, and a replaced contest may return later. The card is one row of
    at most ``high`` contests; its candidates stay spread over the cluster and
    are reduced to one swap before anything is gathered. A round looks at cards
    that were changed by the last one, and tries a candidate only at places where
    the bound of its class and title leaves room for a gain. ``settled`` tells
    whether a card has no improving swap left or ``max_rounds`` ended its search;
    ``swaps`` and ``tried`` count its swaps and the (candidate, place) pairs tried.
    """
    member = F.struct("pos", "fight_id", "name1", "name2", "weight_class", "is_title", "score")
    ordered = chosen.groupBy("card").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "fight_id"))).alias("o")
    ).select("card", F.posexplode("o").alias("pos", "o")).select("card", "pos", "o.fight_id")
    start = chosen.join(ordered, ["card", "fight_id"])
    cards = shared_checkpoint(start.select("card", member.alias("m")))
    active, open_cards = cards, cards.select("card").distinct()
    counts = open_cards.select("card", F.lit(0).cast("long").alias("swaps"), F.lit(0).cast("long").alias("tried"))
    for _ in range(max_rounds):
        state = (
            active.groupBy("card")
            .agg(F.sort_array(F.collect_list("m")).alias("ms"))
            .withColumn("best", estimate(_total("ms", "score"), _titles("ms")))
            .filter(F.size("ms").between(low, high) & (F.col("best") < ESTIMATE_HIGH))
        )
        tried = shared_checkpoint(_first_swaps(scored, state, classes))
        counts = counts.unionByName(tried.select("card", F.col("n").isNotNull().cast("long").alias("swaps"), "tried"))
        swaps = tried.filter(F.col("n").isNotNull())
        open_cards = swaps.select("card")
        if swaps.isEmpty():
            break
        cards = shared_checkpoint(
            cards.join(swaps.select("card", F.col("n.pos").alias("p"), "n"), "card", "left").select(
                "card", F.when(F.col("m.pos") == F.col("p"), F.col("n")).otherwise(F.col("m")).alias("m")
            )
        )
        active = cards.join(swaps.select("card"), "card", "left_semi")
    still = open_cards.select("card", F.lit(False).alias("settled"))
    sums = counts.groupBy("card").agg(F.sum("swaps").alias("swaps"), F.sum("tried").alias("tried"))
    return cards.select("card", "m.*").drop("pos").join(still, "card", "left").withColumn(
        "settled", F.coalesce("settled", F.lit(True))
    ).join(sums, "card")


def _total(members: str | Column, field: str) -> Column:
    return F.aggregate(members, F.lit(0.0), lambda a, m: a + m[field])


def _titles(members: str | Column) -> Column:
    return F.size(F.filter(members, lambda m: m["is_title"]))


def _needs(title: int) -> Column:
    """For each place what a newcomer's score must exceed to raise the estimate by enough."""
    def need(m: Column) -> Column:
        titles = _titles("ms") - F.coalesce(m["is_title"].cast("int"), F.lit(0)) + title
        share = F.col("best") + SMALLEST_GAIN - ESTIMATE_BASE - titles * ESTIMATE_TITLE
        return F.when(share < ESTIMATE_CAP, share * ESTIMATE_SCALE - F.col("total_") + m["score"] - ROUNDING).otherwise(
            F.lit(float("inf"))
        )

    return F.transform("ms", need)


def _first_swaps(scored: DataFrame, state: DataFrame, classes: int) -> DataFrame:
    """(card, n, tried): the newcomer of the first improving swap, with its position, or null.

    Where few cards are open they go to the candidates, which stay where they are. The
    least fight_id of every place is found by plain minima, which are combined as they
    come; the rows of the places chosen are then made whole.
    """
    on_card = F.col("ms.weight_class")
    held = state.withColumns({
        "ids": F.col("ms.fight_id"), "names1": F.col("ms.name1"), "names2": F.col("ms.name2"),
        "total_": _total("ms", "score"),
        # a class that two contests have stays whichever of them leaves
        "twice": F.filter(on_card, lambda c: F.size(F.filter(on_card, lambda d: c == d)) > 1),
    }).withColumns({"plain_needs": _needs(0), "title_needs": _needs(1)}).withColumns({
        "plain_least": F.array_min("plain_needs"), "title_least": F.array_min("title_needs"),
        "places": F.transform("ms", _place),
    }).drop("ms", "total_", "plain_needs", "title_needs")
    held = broadcast_checked(held, FEW_CARDS)
    good = F.col("good")
    by_place = _tries(scored, held, classes).groupBy("card", "pos").agg(
        F.min(F.when(good, F.col("fight_id"))).alias("fight_id"), F.count("*").alias("tried")
    )
    won = F.struct("pos", "fight_id")
    first = shared_checkpoint(
        by_place.groupBy("card").agg(
            F.min(F.when(F.col("fight_id").isNotNull(), won)).alias("won"), F.sum("tried").alias("tried")
        )
    )
    wins = broadcast_checked(first.filter(F.col("won").isNotNull()).select("card", "won.*"))
    whole = _tries(scored.join(wins.drop("pos"), ["card", "fight_id"], "left_semi"), held, classes).filter(good)
    newcomer = F.struct(
        "pos", "fight_id", "name1", "name2", "weight_class", "is_title", F.col("new_score").alias("score")
    )
    made = whole.join(wins, ["card", "pos", "fight_id"], "left_semi").groupBy("card").agg(F.min(newcomer).alias("n"))
    return first.select("card", "tried").join(made, "card", "left").select("card", "n", "tried")


def _place(out: Column, at: Column) -> Column:
    """What is left of the card without the contest of one place, and what a newcomer needs there."""
    rest = F.concat(F.slice("ms", 1, at), F.slice("ms", at + 2, F.size("ms")))
    return F.struct(
        out["pos"].alias("pos"), F.get("plain_needs", at).alias("plain_need"), F.get("title_needs", at).alias("title_need"),
        F.array_distinct(F.transform(rest, lambda m: m["weight_class"])).alias("classes"),
        _total(rest, "score").alias("total"), _titles(rest).alias("titles"),
    )


def _tries(scored: DataFrame, held: DataFrame, classes: int) -> DataFrame:
    """A row of every candidate and place that leave room for a gain, with its place, its score there and whether it is one."""
    most = F.col("base") + F.when(F.array_contains("twice", F.col("weight_class")), 0.0).otherwise(NEW_CLASS_BONUS)
    least = F.when(F.col("is_title"), F.col("title_least")).otherwise(F.col("plain_least"))
    pairs = scored.join(held, "card").filter(
        ~F.array_contains("ids", F.col("fight_id")) & F.coalesce(most > least, F.lit(True))
    )

    def place(name: str) -> Column:
        """1-based position of the contest a name is in, 0 if it is on none."""
        return F.greatest(*[F.array_position(side, F.col(name)) for side in ("names1", "names2")])

    # a newcomer may only replace the one contest that holds its names
    one, two = F.col("at1"), F.col("at2")
    spots = (
        F.when((one == 0) & (two == 0), F.col("places"))
        .when((one == 0) | (two == 0) | (one == two), F.array(F.get("places", F.greatest(one, two).cast("int") - 1)))
    )

    def room_at(p: Column) -> Column:
        return F.coalesce(most > F.when(F.col("is_title"), p["title_need"]).otherwise(p["plain_need"]), F.lit(True))

    tried = pairs.withColumns({"at1": place("name1"), "at2": place("name2")}).withColumn("to", F.explode(F.filter(spots, room_at)))
    is_new = ~F.array_contains("to.classes", F.col("weight_class"))
    tried = tried.withColumn("new_score", F.col("base") + F.when(is_new, NEW_CLASS_BONUS).otherwise(0.0))
    value = estimate(F.col("to.total") + F.col("new_score"), F.col("to.titles") + F.col("is_title").cast("int"))
    enough = F.size("to.classes") + is_new.cast("int") >= classes
    return tried.select(
        "card", "to.pos", "fight_id", "name1", "name2", "weight_class", "is_title", "new_score",
        (enough & (value > F.col("best") + SMALLEST_GAIN)).alias("good"),
    )


def optimize_cards(candidates: DataFrame, capacity: int = 20_000) -> tuple[DataFrame, DataFrame]:
    """(chosen contests, estimates): greedy start, then improvement."""
    scored = shared_checkpoint(score_candidates(candidates))
    chosen = improve_cards(scored, greedy_cards(scored))
    return chosen, card_estimates(candidates, chosen, capacity)
