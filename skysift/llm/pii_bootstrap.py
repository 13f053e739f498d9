"""Personal data: fixed patterns, then bootstrapped contextual extraction (native).

The four base kinds are found by regular expressions. Their spans are the
seeds of a bootstrap, and so are strings of 32 hexadecimal digits or more, the
seeds of a fifth kind, `secret`, which are no spans by themselves. The words
around a seed are its lexical patterns: what is glued to it with the next word
on its left, with the next two, with the next on its right, and both sides; a
context is read from `REACH` code points on each side at the most. A pattern is
scored by the share of the identifier-like strings it surrounds that are
(likely) of a kind, an identifier by its best pattern, over a few rounds on the
graph of patterns and instances. Identifiers that stand in a pattern of high
confidence, met with enough different seeds, become spans of the kind too, and
seeds of the next generation, which may trust more patterns; it ends when a
generation adds no seed. All of it is SQL functions, joins and aggregates; the
graph holds distinct (pattern, instance) edges, so a very common context is one
short row for each different instance and never a group in one task.

Identifier-like are runs of letters, digits and inner hyphens, groups of such
runs, and addresses with a bracketed "at", of six characters or more; the first
two with four digits or more. Strings of letters alone are none.

The expressions start a match only where a run of the leading class begins or
where the last match ended (``\\G``), and repeat possessively. Both change no
match and keep the search linear on very long runs.

Edge cases: null texts are empty and have no spans. Rows that repeat an id,
also a null one, get the spans of their own text. Positions count code points.
Input columns may have any names; `redact` passes them on.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skysift.llm.common import written

KINDS = ("email", "ip", "card", "phone")
#: The kinds of spans: the base kinds, and what context alone finds.
NAMES = (*KINDS, "secret")
SECRET = r"^[0-9A-Fa-f]{32,}$"
REACH = 64
_LOCAL = "[A-Za-z0-9._%+-]"
_LABEL = "[A-Za-z0-9-]++"
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}(?:\.{_LABEL})++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: An identifier-like string: a run of letters, digits and inner hyphens with a digit in it.
IDENTIFIER = r"(?<![\p{L}\p{N}])(?=[\p{L}-]*+[0-9])[\p{L}\p{N}][\p{L}\p{N}-]*+"
#: Such runs in groups: the first one has a digit, the others start with one; brackets, a space, dot, slash or hyphen between them. Runs after a hyphen may follow.
GROUPS = r"(?<![\p{L}\p{N}])\(?+(?=\p{L}*+[0-9])[\p{L}\p{N}]++(?:(?:\)[ ./-]?|[ ./-]\(?)[0-9][\p{L}\p{N}]*+)++(?:-[\p{L}\p{N}]++)*+"
#: An address with its sign written out in brackets.
_AT = r"[(\[{] ?(?i:at) ?[)\]}]"
HANDLE = rf"(?<![\p{{L}}\p{{N}}._+-])[\p{{L}}\p{{N}}._+-]++ ?{_AT} ?[\p{{L}}\p{{N}}-]++(?:\.[\p{{L}}\p{{N}}-]++)*+"
_SOME = rf"[0-9@]|{_AT}"
SPAN = "struct<kind:int,start:int,end:int>"
_FOUND = "array<struct<start:int,text:string>>"


def _matches(text: Column, pattern: str) -> Column:
    """All matches with their starts in code points (from 0)."""
    texts = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    steps = F.zip_with(texts, F.slice(gaps, F.lit(1), F.size(texts)), lambda m, g: F.struct(F.length(g).alias("gap"), m.alias("text")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_FOUND).alias("found"))
    return F.aggregate(
        steps,
        start,
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + F.length(x["text"])).alias("at"),
            F.concat(acc["found"], F.array(F.struct((acc["at"] + x["gap"]).alias("start"), x["text"].alias("text")))).alias("found"),
        ),
        lambda acc: acc["found"],
    )


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)
    value = lambda i: F.substring(back, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
    total = F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1))), F.lit(0), lambda acc, i: acc + F.when(value(i) > 9, value(i) - 9).otherwise(value(i)))
    return total % 10 == 0


def _valid(kind: str, text: Column) -> Column:
    n = F.length(_digits(text))
    return {
        "email": lambda: F.lit(True),
        "ip": lambda: text.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"),
        "card": lambda: F.when(n.between(13, 19), _luhn(_digits(text))).otherwise(False),
        "phone": lambda: n.between(9, 15),
    }[kind]()


#: What a text must hold for a match of the kind; saves the longer search.
_NEEDS = {"email": lambda t: t.contains("@"), "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"), "card": lambda t: t.rlike(r"[0-9][ -]?[0-9]"), "phone": lambda t: t.contains("+")}


def base_spans(text: Column) -> Column:
    """Spans of the four kinds as struct(kind, start, end), by kind and start. Unnormalised text in, null is empty."""

    def of_kind(i: int, kind: str) -> Column:
        valid = F.filter(_matches(text, PATTERNS[kind]), lambda x: _valid(kind, x["text"]))
        found = F.when(_NEEDS[kind](text), valid).otherwise(F.array().cast(_FOUND))
        return F.transform(found, lambda x: F.struct(F.lit(i).alias("kind"), x["start"].alias("start"), (x["start"] + F.length(x["text"])).alias("end")))

    return F.coalesce(F.concat(*[of_kind(i, kind) for i, kind in enumerate(KINDS)]), F.array().cast(f"array<{SPAN}>"))


def span_text(spans: Column) -> Column:
    names = F.array(*map(F.lit, NAMES))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _patterns(text: Column, span: Column) -> Column:
    """The lexical patterns of a span: the words around it, each with what is glued to the span; case and digits levelled."""
    level = lambda c: F.translate(F.lower(c), "123456789", "000000000")
    first = F.greatest(span["start"] - REACH, F.lit(0))
    left, right = F.substring(text, first + 1, span["start"] - first), F.substring(text, span["end"] + 1, F.lit(REACH))
    one, two = (level(F.regexp_extract(left, rf"(?:\S+\s+){{0,{n}}}\S*$", 0)) for n in (1, 2))
    after = level(F.regexp_extract(right, r"^\S*(?:\s+\S+)?", 0))
    made = F.array(F.concat(F.lit("L "), one), F.concat(F.lit("M "), two), F.concat(F.lit("R "), after), F.concat(F.lit("B "), one, F.lit(" _ "), after))
    return F.array_distinct(F.filter(made, lambda p: F.length(F.trim(F.substring(p, F.lit(2), F.length(p)))) > 1))


def _trusted(edges: DataFrame, generation: int, rounds: int, confidence: float, support: int) -> DataFrame:
    """The patterns that reach the confidence with enough seeds: pattern, score, kind."""
    scores = [F.col(f"s{i}") for i in range(len(NAMES))]
    instances = edges.groupBy("token").agg(*[F.max(f"seed{i}").alias(f"s{i}") for i in range(len(NAMES))])
    for step in range(rounds):
        n = F.count(F.lit(1))
        patterns = edges.join(instances, "token").groupBy("pattern").agg(*[(F.sum(s) / (n + 1)).alias(f"p{i}") for i, s in enumerate(scores)], *[F.sum(f"seed{i}").alias(f"n{i}") for i in range(len(NAMES))])
        patterns = patterns.select("pattern", *[F.when(F.col(f"n{i}") >= support, F.col(f"p{i}")).otherwise(0.0).alias(f"p{i}") for i in range(len(NAMES))])
        patterns = written(patterns, f"pii-patterns-{generation}-{step}")
        if step + 1 < rounds:
            instances = edges.join(patterns, "pattern").groupBy("token").agg(*[F.max(F.greatest(F.col(f"seed{i}"), F.col(f"p{i}"))).alias(f"s{i}") for i in range(len(NAMES))])
    best = F.greatest(*[F.col(f"p{i}") for i in range(len(NAMES))])
    which = reduce(lambda a, i: F.when(F.col(f"p{i}") == best, F.lit(i)).otherwise(a), reversed(range(len(NAMES))), F.lit(0))
    return patterns.filter(best >= confidence).select("pattern", best.alias("score"), which.alias("kind"))


def bootstrap(found: DataFrame, *, rounds: int = 3, confidence: float = 0.8, support: int = 5) -> DataFrame:
    """Spans that context adds: id, text_hash, added array of spans.

    `found` has id, text_hash and `seen`: struct(start, end, base, seed, token,
    patterns), where `seed` is a kind or null, and `base` tells spans that stand
    already. A pattern counts with `support` different seeds of a kind or more,
    and gives its kind to other identifiers where its smoothed score reaches
    `confidence`. These are seeds of the next generation.
    """
    seen = found.select("id", "text_hash", F.explode("seen").alias("s")).select("id", "text_hash", "s.*")
    edges = seen.select(F.explode("patterns").alias("pattern"), "token", "seed").groupBy("pattern", "token").agg(*[F.max((F.coalesce(F.col("seed"), F.lit(-1)) == i).cast("double")).alias(f"seed{i}") for i in range(len(NAMES))])
    # Only patterns that meet enough different strings can ever be trusted; the others are left out of the graph.
    usable = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= support)
    edges = written(edges.join(usable.select("pattern"), "pattern", "left_semi"), "pii-edges")
    no_seed = sum(F.col(f"seed{i}") for i in range(len(NAMES))) == 0
    generation = 0
    while True:
        trusted = _trusted(edges, generation, rounds, confidence, support)
        met = edges.filter(no_seed).select("pattern", "token").join(trusted, "pattern")
        gained = written(met.groupBy("token").agg(*[F.max((F.col("kind") == i).cast("double")).alias(f"g{i}") for i in range(len(NAMES))]), f"pii-gained-{generation}")
        if not gained.head(1):
            break
        more = [F.when(no_seed, F.coalesce(f"g{i}", F.lit(0.0))).otherwise(F.col(f"seed{i}")).alias(f"seed{i}") for i in range(len(NAMES))]
        edges = written(edges.join(gained, "token", "left").select("pattern", "token", *more), f"pii-edges-{generation}")
        generation += 1
    new = seen.filter("not base").select("id", "text_hash", "start", "end", F.explode("patterns").alias("pattern")).join(trusted, "pattern")
    one = new.groupBy("id", "text_hash", "start", "end").agg(F.max(F.struct(F.col("score"), (-F.col("kind")).alias("kind"))).alias("k"))
    span = F.struct((-F.col("k.kind")).alias("kind"), F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"))
    return one.groupBy("id", "text_hash").agg(F.collect_list(span).alias("added"))


def _base(t: Column) -> Column:
    return F.when(t.rlike("[0-9@]"), base_spans(t)).otherwise(F.array().cast(f"array<{SPAN}>"))


def _found(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text_hash, base, seen), written."""
    t = F.col("t")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("t")).withColumn("base", _base(t))
    token = lambda s: F.lower(F.substring(t, s["start"] + 1, s["end"] - s["start"]))
    seen = lambda s, base, seed: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(base).alias("base"), seed.alias("seed"), token(s).alias("token"), _patterns(t, s).alias("patterns"))
    span = lambda m: F.struct(F.lit(None).cast("int").alias("kind"), m["start"].alias("start"), (m["start"] + F.length(m["text"])).alias("end"))
    digits = lambda pattern: F.transform(F.filter(_matches(t, pattern), lambda m: (F.length(m["text"]) >= 6) & (F.length(_digits(m["text"])) >= 4)), span)
    handles = F.when(t.rlike(_AT), F.transform(F.filter(_matches(t, HANDLE), lambda m: F.length(m["text"]) >= 6), span)).otherwise(F.array().cast(f"array<{SPAN}>"))
    apart = lambda spans, of: F.filter(spans, lambda o: ~F.exists(of, lambda b: (b["start"] < o["end"]) & (b["end"] > o["start"])))
    # The widest string that no base span cuts: handles, then groups, then single runs.
    rows = rows.withColumn("wide", F.when(t.rlike(_SOME), apart(handles, "base")))
    rows = rows.withColumn("wide", F.when(t.rlike(_SOME), F.concat("wide", apart(apart(digits(GROUPS), "base"), "wide"))))
    free = F.concat("wide", apart(apart(digits(IDENTIFIER), "base"), "wide"))
    secret = lambda s: F.when(token(s).rlike(SECRET), F.lit(len(KINDS)))
    both = F.concat(F.transform("base", lambda s: seen(s, True, s["kind"])), F.transform(free, lambda s: seen(s, False, secret(s))))
    return written(rows.select("id", "text_hash", "base", F.when(t.rlike(_SOME), both).alias("seen")), "pii-found")


def find_pii(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """One row a document: id, text_hash, base and spans (arrays of struct(kind, start, end) by kind, then start)."""
    found = _found(docs, id_col, text_col)
    added = bootstrap(found.filter(F.size("seen") > 0), **params)
    same = F.col("f.id").eqNullSafe(F.col("a.id")) & (F.col("f.text_hash") == F.col("a.text_hash"))
    both = found.alias("f").join(added.alias("a"), same, "left").select("f.id", "f.text_hash", "f.base", F.col("a.added").alias("added"))
    return both.select("id", "text_hash", "base", F.when(F.col("added").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "added"))).alias("spans"))


def redact(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """The documents with each span in their text replaced by its kind in angle brackets; overlapping spans become one.

    Base spans are found again where the text is. A text without digits, "@"
    and its spelling has no spans and is passed on as it is; only the others
    meet the spans that context adds.
    """
    t = F.col("t")
    added = bootstrap(_found(docs, id_col, text_col).filter(F.size("seen") > 0), **params)
    added = written(added.select("id", "text_hash", "added"), "pii-added")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("own_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    some = rows.filter(t.rlike(_SOME)).withColumn("own_hash", F.xxhash64("t"))
    # Always a shuffled join, so that the plan is the same at every size.
    some = some.join(added.hint("merge"), F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_hash") == F.col("text_hash")), "left")
    spans = F.concat(_base(t), F.coalesce("added", F.array().cast(f"array<{SPAN}>")))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in NAMES])
    done = F.aggregate(
        "ordered",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.when(s["end"] <= acc["at"], acc).otherwise(
            F.struct(
                s["end"].alias("at"),
                F.concat(acc["out"], F.when(s["start"] < acc["at"], F.lit("")).otherwise(F.concat(F.substring(t, acc["at"] + 1, s["start"] - acc["at"]), F.get(names, s["kind"])))).alias("out"),
            )
        ),
        lambda acc: F.concat(acc["out"], F.substring(t, acc["at"] + 1, F.length(t))),
    )
    some = some.withColumn("ordered", ordered).select("row", F.when(F.size("ordered") > 0, done).alias("new"))
    every = some.unionByName(rows.filter(~t.rlike(_SOME)).select("row", F.lit(None).cast("string").alias("new")))
    return every.select(*[F.coalesce("new", F.col("row").getField(c)).alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])
