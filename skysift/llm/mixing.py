"""Mixing sources to target weights by temperature (native).

Each source's share of the tokens is raised to an exponent a in [0, 1] and
normalised: 1 keeps the natural mix, 0 makes all sources equal. The exponent is
found by bisection: the largest that reaches a target entropy, or the smallest
change that respects a limit on how often a document is repeated. A job
evaluates the 63 points that six bisection steps can reach, so the sources stay
a table, however many they are, and only 63 numbers come to the driver.

The weights become token budgets. A source is cut into blocks of about
`block_tokens` tokens by hash. Whole epochs take every block; the last, partial
epoch takes blocks in the order of a random permutation until the budget ends
within one block, and of that block the documents in hash order, never above
the budget. The permutation is the order of a hash, so its end is one place for
each source, found by sums over 1,024 ranges of the hash and then within one
range; a document compares its own place with it. So nothing but a row for each
source meets the documents, and no ordered group holds a source's blocks.

Lengths are counts of words, or those of the column `tokens_col`, such as an
encoder gives.

Edge cases: a null source is a source. Null and empty texts have no tokens:
they are kept once, and cost nothing. Rows that repeat, or have no id, each
count; equal rows share a hash and are taken or left together, as long as they
fit. Input columns may have any names: those named like a column that is added
are replaced by it, and `mixed_documents` returns all of them unchanged.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skysift.llm.common import written

WORD = r"[^\x20\x09-\x0D]+"
_STEPS, _JOBS = 6, 5


def count_tokens(text: Column) -> Column:
    """Words, as the measure of length where no tokenizer is asked for."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def _bisect(evaluate, good) -> float:
    """The largest a in [0, 1] with good(a), which holds up to some a and not beyond; 0 at least."""
    low, high = 0.0, 1.0
    if good(evaluate([1.0])[1.0]):
        return 1.0
    for _ in range(_JOBS):
        n = 2**_STEPS
        values = evaluate([low + (high - low) * i / n for i in range(1, n)])
        points = sorted(values)
        last = max((a for a in points if good(values[a])), default=low)
        low, high = last, min((a for a in points if a > last), default=high)
    return low


def exponent_for_entropy(sources: DataFrame, target: float) -> float:
    """The largest exponent at which the entropy is at least `target` times that of equal sources."""
    shares = _shares(sources)

    def evaluate(points: list[float]) -> dict[float, float]:
        power = F.pow(F.col("p"), F.col("a"))
        rows = shares.select("p", F.explode(F.array(*map(F.lit, points))).alias("a")).groupBy("a").agg(F.sum(power).alias("z"), F.sum(power * F.col("a") * F.log("p")).alias("s"), F.count(F.lit(1)).alias("n"))
        return {r.a: (math.log(r.z) - r.s / r.z) / math.log(r.n) if r.n > 1 else 1.0 for r in rows.collect()}

    return _bisect(evaluate, lambda h: h >= target) if shares.head(1) else 1.0


def exponent_for_repetition(sources: DataFrame, limit: float) -> float:
    """The smallest exponent at which, with every source passed once or more, none is passed more than `limit` times."""
    shares = _shares(sources)

    def evaluate(points: list[float]) -> dict[float, float]:
        # passes of a source: proportional to share ** (a - 1); mirrored, because _bisect seeks the largest
        rows = shares.select("p", F.explode(F.array(*map(F.lit, points))).alias("a")).groupBy("a").agg((F.max(F.pow("p", -F.col("a"))) / F.min(F.pow("p", -F.col("a")))).alias("r"))
        return {r.a: r.r for r in rows.collect()}

    return 1.0 - _bisect(evaluate, lambda r: r <= limit) if shares.head(1) else 1.0


def _shares(sources: DataFrame) -> DataFrame:
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    return sources.filter("tokens > 0").select((F.col("tokens") / F.lit(float(max(total, 1)))).alias("p"))


def plan_mix(docs: DataFrame, *, target_entropy: float | None = None, max_repetition: float | None = None, budget_tokens: int | None = None, block_tokens: int = 200_000, seed: int = 7) -> DataFrame:
    """One row a source for `docs` (source, tokens, hash), as `copies_of` needs it.

    Columns: source, weight, budget, blocks, epochs, and where the partial epoch
    ends: the place `cut` (range, perm, block; its documents up to the hash
    `last`, null: none). Without `budget_tokens` the budget is the corpus
    itself, or with `max_repetition` what passes every source once or more.
    """
    counted = docs.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    sources = written(counted, "mix-sources")
    exponent = 1.0
    if target_entropy is not None:
        exponent = exponent_for_entropy(sources, target_entropy)
    if max_repetition is not None:
        exponent = max(exponent if target_entropy is not None else 0.0, exponent_for_repetition(sources, max_repetition))
    power = F.when(F.col("tokens") > 0, F.pow(F.col("tokens").cast("double"), F.lit(exponent))).otherwise(0.0)
    z, total, once = sources.agg(F.sum(power), F.sum("tokens"), F.max(F.when(F.col("tokens") > 0, F.col("tokens") / power))).first()
    z, total, once = z or 1.0, total or 0, once or 0.0
    budget = budget_tokens if budget_tokens is not None else total if max_repetition is None else once * z
    weight = power / F.lit(float(z or 1.0))
    # Rounding must not turn an exact pass into one that lacks a token.
    share = F.floor(weight * F.lit(float(budget)) + 1e-6 * F.col("tokens")).cast("long")
    blocks_of = F.greatest(F.ceil(F.greatest(F.col("tokens"), F.col("docs")) / F.lit(float(block_tokens))), F.lit(1)).cast("long")
    epochs = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(1).cast("long")
    sources = sources.select("source", "tokens", weight.alias("weight"), share.alias("budget"), blocks_of.alias("blocks")).withColumn("epochs", epochs)
    sources = written(sources.withColumn("left", F.col("budget") - F.col("epochs") * F.col("tokens")), "mix-plan")

    placed = docs.join(sources.filter("tokens > 0").select("source", "blocks", "epochs", "left"), "source").withColumn("place", place_of(seed))
    blocks = written(placed.groupBy("source", "place").agg(F.sum("tokens").alias("n"), F.first("left").alias("left")).withColumn("range", F.col("place.range")), "mix-blocks")
    ranges = blocks.groupBy("source", "range").agg(F.sum("n").alias("n"), F.first("left").alias("left"))
    upto = lambda order: F.sum("n").over(Window.partitionBy("source").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # The first range, and in it the first block, that passes what is left.
    ranges = ranges.withColumn("upto", upto("range")).filter("upto > left").groupBy("source").agg(F.min_by(F.struct("range", (F.col("upto") - F.col("n")).alias("before")), "range").alias("r"))
    inner = blocks.join(ranges.select("source", "r.*"), ["source", "range"]).withColumn("upto", F.col("before") + upto("place")).filter("upto > left")
    cut = written(inner.groupBy("source").agg(F.min_by(F.struct("place", (F.col("left") - F.col("upto") + F.col("n")).alias("room")), "place").alias("c")).select("source", F.col("c.place").alias("cut"), "c.room"), "mix-cuts")
    # Of that block the documents are taken in hash order up to the room.
    part = placed.join(cut, "source").filter("place = cut").withColumnRenamed("tokens", "n")
    within = Window.partitionBy("source").orderBy("hash").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    last = part.withColumn("used", F.sum("n").over(within)).filter("used <= room").groupBy("source").agg(F.max("hash").alias("last"))
    return written(sources.join(cut.select("source", "cut"), "source", "left").join(last, "source", "left").select("source", "weight", "budget", "blocks", "epochs", "cut", "last"), "mix-copies")


def place_of(seed: int) -> Column:
    """A document's place in the permutation of its source's blocks (needs source, hash, blocks and epochs)."""
    block = F.pmod(F.xxhash64(F.lit("block"), "hash"), F.col("blocks"))
    perm = F.xxhash64(F.lit(seed), F.col("source"), F.col("epochs"), block)
    return F.struct(F.shiftrightunsigned(perm, 54).alias("range"), perm.alias("perm"), block.alias("block"))


def copies_of(seed: int) -> Column:
    """How often the mix takes a document (needs tokens and hash and the plan's columns)."""
    place = place_of(seed)
    extra = F.coalesce((place < F.col("cut")) | ((place == F.col("cut")) & (F.col("hash") <= F.col("last"))), F.lit(False))
    return F.when(F.col("tokens") == 0, 1).otherwise(F.col("epochs") + extra.cast("long")).cast("long")


def _mixed(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", tokens_col: str | None = None, seed: int = 7, **targets) -> DataFrame:
    """(row, tokens, weight, copies): the documents as structs, so that no name of theirs can clash."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("null"))
    tokens = count_tokens(F.col(text_col)) if tokens_col is None else F.coalesce(F.col(tokens_col), F.lit(0)).cast("long")
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("source"), tokens.alias("tokens"), F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), text).alias("hash"))
    # The plan reads the counts several times; the texts are counted once.
    slim = written(marked.select("source", "tokens", "hash"), "mix-docs")
    plan = plan_mix(slim, seed=seed, **targets)
    return marked.join(plan, "source").select("row", "tokens", "weight", copies_of(seed).alias("copies"))


def mix_sources(docs: DataFrame, **params) -> DataFrame:
    """`docs` with __tokens, __weight and __copies: how often the mix takes the document (0: not)."""
    added = {"__tokens": "tokens", "__weight": "weight", "__copies": "copies"}
    own = [F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() not in added]
    return _mixed(docs, **params).select(*own, *[F.col(c).alias(name) for name, c in added.items()])


def mixed_documents(docs: DataFrame, **params) -> DataFrame:
    """The documents with their own columns, each as often as the mix takes it."""
    taken = _mixed(docs, **params).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
