"""Personal data by rules, and beyond them by bootstrapped contexts, in Catalyst alone.

Seeds. Four kinds of entities have a fixed form and are found by regular expressions. A fifth kind, secret, has two sorts
of seeds: keys of published forms, and long random-looking strings that are assigned to a name (other than those of public digests).

Patterns. A value's patterns are lexical: the word before it, the two before it, the words on either side, the name that it is assigned
to (name = value, name: "value"), and the form "assigned and random-looking". Words are whole, lie between white space,
quotes, brackets and signs of assignment, and digit groups with single spaces between are one word.

Graph. Distinct pattern-value edges form a graph. In each round a pattern is supported if SUPPORT of its values at least
are seeds or found; its confidence is the mean confidence of all its distinct values, and a value's is the mean of its
supported patterns. A value is found once it is at CONFIDENCE or above, with two supported patterns or one of STRONG
known values; then it supports further patterns, such as another name that secrets are assigned to.

Texts are never shuffled but those of documents with seeds or finds, where these are too many to broadcast their row
numbers. Patterns of words that seeds stand in are counted first, in the documents with seeds (their texts are written
once) and what is left in all documents, and only those where seeds make up SHARE of all occurrences give edges, so no
edge is made for a word after "of the". Over all documents a row is made for an occurrence of such a pattern alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Scratch

#: Kinds in the order in which they are listed; the first four are those of fixed form.
KINDS = ["email", "ip", "card", "phone", "secret"]
BASE, SECRET = KINDS[:4], 4
#: Forms, as searched for: a run is only tried at its start, so that long runs cost linear time.
FORMS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}",
    "card": r"[0-9](?<![0-9][0-9])(?<![0-9][\x20-][0-9])(?:[\x20-]?[0-9]){13,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this has no entity of the kind.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
#: Keys of published forms: access key ids and personal access tokens of two widely used services.
KEY = r"(?<![A-Za-z0-9_])(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36})(?![A-Za-z0-9_])"
KEY_NEEDS = ["AKIA", "ASIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_"]
#: An assigned random-looking string is a seed if it has so many signs and its name is none of those that say what a
#: public digest or number is.
LONG, PUBLIC = 32, "checksum commit digest etag hash id integrity md5 revision sha sha1 sha256 sha512 uuid version".split()
#: A random-looking string: twelve signs or more, of them three digits and three letters at least.
RANDOM = r"^(?=(?:[^0-9]*+[0-9]){3})(?=(?:[^A-Za-z]*+[A-Za-z]){3})[A-Za-z0-9+/_-]{12,}+$"
#: What lies between words, with the marks that end a word before it and brackets that open the next one.
SPACE = r"\s\"'<>{},;=:"
BETWEEN = rf"[.!?)\]]*+[{SPACE}]++(?:[(\[]++(?![0-9]))?+"
ASSIGNED = rf"(?<![A-Za-z0-9_.-])([A-Za-z_][A-Za-z0-9_.-]*+)[\"']?+[ \t]*+[=:][ \t]*+[\"']?+[(\[]*+([^{SPACE}]++)"
#: Stands in place of a space inside a value. A text's own is read as a space.
JOIN = "\ufdd1"
ROUNDS, SUPPORT, STRONG, SHARE, CONFIDENCE = 4, 3, 20, 0.05, 0.8
SPAN = "array<struct<start: int, kind_no: int, end: int, value: string>>"


def spans_of(text: Column, form: str | Column, kind_no: int | Column, needs: str | None = None) -> Column:
    """All matches of form with code-point places: what stands between them gives the places by its lengths."""
    form, kind_no = (x if isinstance(x, Column) else F.lit(x) for x in (form, kind_no))
    found, between = F.regexp_extract_all(text, form, F.lit(0)), F.split(text, form)
    none = F.array().cast(SPAN)
    walk = F.aggregate(
        F.zip_with(found, F.slice(between, F.lit(1), F.size(found)), lambda m, b: F.struct(m.alias("m"), F.length(b).alias("gap"), F.length(m).alias("n"))),
        F.struct(F.lit(0).alias("at"), none.alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["n"]).alias("at"),
            F.array_append(acc["out"], F.struct((acc["at"] + x["gap"]).alias("start"), kind_no.alias("kind_no"), (acc["at"] + x["gap"] + x["n"]).alias("end"), x["m"].alias("value"))).alias("out"),
        ),
        lambda acc: acc["out"],
    )
    guard = text.contains(needs) if needs else F.regexp_like(text, form)
    return F.when(guard, walk).otherwise(none)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    d = F.reverse(digits(value))
    doubled = F.transform(
        F.sequence(F.lit(1), F.length(d)),
        lambda i: (F.substr(d, i, F.lit(1)).cast("int") * (2 - i % 2)),
    )
    return F.aggregate(doubled, F.lit(0), lambda s, x: s + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


def small_parts(value: Column) -> Column:
    """Four numbers of at most 255, whatever zeros lead them."""
    part = lambda p: F.regexp_replace(p, "^0+(?=.)", "")
    return F.forall(F.split(value, r"\."), lambda p: (F.length(part(p)) <= 3) & (F.substr(part(p), F.lit(1), F.lit(3)).cast("int") <= 255))


VALID = {
    "email": lambda v: F.lit(True),
    "ip": small_parts,
    "card": lambda v: F.length(digits(v)).between(14, 19) & luhn(v),
    "phone": lambda v: F.length(digits(v)).between(10, 15),
}


def entities(text: Column) -> Column:
    """Spans of all four kinds, by start and then kind."""
    def of(i: int, kind: str) -> Column:
        return F.filter(spans_of(text, FORMS[kind], i, NEEDS[kind]), lambda x: VALID[kind](x["value"]))

    return F.array_sort(F.concat(*[of(i, kind) for i, kind in enumerate(BASE)]))


def cleaned(text: Column) -> Column:
    """text with a space for each JOIN of its own."""
    return F.replace(text, F.lit(JOIN), F.lit(" "))


def marked(text: Column, base: Column) -> Column:
    """text with JOIN for white space inside each span in base and a space on either side of it."""
    piece = lambda x, at: F.replace(F.substr(text, F.greatest(x["start"], at) + 1, x["end"] - F.greatest(x["start"], at)), F.lit(" "), F.lit(JOIN))
    done = F.aggregate(
        base,
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda acc, x: F.struct(
            F.when(x["end"] <= acc["at"], acc["out"])
            .otherwise(F.concat(acc["out"], F.substr(text, acc["at"] + 1, F.greatest(x["start"] - acc["at"], F.lit(0))), F.lit(" "), piece(x, acc["at"]), F.lit(" ")))
            .alias("out"),
            F.greatest(acc["at"], x["end"]).alias("at"),
        ),
        lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1, F.length(text))),
    )
    return F.when(F.size(base) > 0, done).otherwise(text)


#: What a word's patterns of each shape are made of.
SHAPES = {"L": ["before"], "LL": ["earlier", "before"], "LR": ["before", "after"]}


def in_context(rows: DataFrame, slots: DataFrame | None = None, n: int = 0) -> DataFrame:
    """(row, value, pattern) for each word of rows (row, text as marked() gives it): the word before it, the two before
    it, the words on either side. Only those among slots (pattern; n distinct rows), if these are given: no row is made
    for another pattern of a word, however common the words around it."""
    whole = F.concat(F.lit(" "), F.regexp_replace("text", r" (?<=[0-9)] )(?=[0-9(+])", JOIN), F.lit(" "))
    # A text and its lower case have their spaces at the same words; what is before the first word and after the last is empty.
    words = rows.select("row", F.split(whole, BETWEEN).alias("w"), F.split(F.lower(whole), BETWEEN).alias("l"))
    k = F.size("l") - 2
    part = lambda c, i: F.slice(c, F.lit(i), k)
    zipped = F.arrays_zip(
        F.concat(F.array(F.lit("")), F.slice("l", F.lit(1), k - 1)).alias("earlier"), part("l", 1).alias("before"), part("w", 2).alias("value"), part("l", 3).alias("after")
    )
    z = words.where(k > 0).select("row", F.explode(zipped).alias("z")).select("row", "z.*")
    if slots is None:
        return z.select("row", "value", F.explode(F.array(*[F.concat_ws(" ", F.lit(k), *parts) for k, parts in SHAPES.items()])).alias("pattern"))
    # Words have no spaces, so a pattern's parts are what stands between its own.
    at = F.split("pattern", " ")
    for k, parts in SHAPES.items():
        known = slots.where(at[0] == k).select(*[at[i + 1].alias(x) for i, x in enumerate(parts)], F.col("pattern").alias(k))
        z = z.join(small(known, n), parts, "left")
    z = z.where(F.coalesce(*SHAPES).isNotNull())
    return z.select("row", "value", F.explode(F.array_compact(F.array(*SHAPES))).alias("pattern"))


def assigned(text: Column) -> Column:
    """(name, value) of what text assigns."""
    both = [F.regexp_extract_all(text, F.lit(ASSIGNED), F.lit(i)) for i in (1, 2)]
    found = F.zip_with(*both, lambda n, v: F.struct(F.lower(n).alias("name"), F.rtrim(v, F.lit(".!?)]")).alias("value")))
    return F.when(text.contains("=") | text.contains(":"), F.filter(found, lambda x: x["value"] != "")).otherwise(F.array().cast("array<struct<name: string, value: string>>"))


def keys(text: Column) -> Column:
    guard = F.lit(False)
    for k in KEY_NEEDS:
        guard = guard | text.contains(k)
    return F.when(guard, F.regexp_extract_all(text, F.lit(KEY), F.lit(0))).otherwise(F.array().cast("array<string>"))


def small(df: DataFrame, n: int) -> DataFrame:
    """df for a join, broadcast if it has so few rows that its size is bounded."""
    return F.broadcast(df) if n <= BROADCAST_ROWS // 10 else df


def bootstrap(edges: DataFrame, seeds: DataFrame, scratch: Scratch) -> DataFrame:
    """(value, kind) of the values found: edges (pattern, value) are distinct, seeds (value, kind) have one row a value."""
    graph = edges.join(seeds.withColumn("seed", F.lit(True)), "value", "left")
    graph = graph.select("pattern", "value", F.coalesce("seed", F.lit(False)).alias("seed"), "kind", F.col("seed").isNotNull().cast("double").alias("confidence"))
    graph = scratch.keep(graph, "graph")
    for _ in range(ROUNDS):
        known = lambda k: F.sum((F.col("kind") == k).cast("int"))
        counts = graph.groupBy("pattern").agg(F.avg("confidence").alias("p"), F.coalesce(F.count("kind"), F.lit(0)).alias("support"), F.array(*[F.coalesce(known(k), F.lit(0)) for k in range(len(KINDS))]).alias("of"))
        counts = scratch.keep(counts.where(F.col("support") >= SUPPORT).select("pattern", "p", "support", (F.array_position("of", F.array_max("of")) - 1).cast("int").alias("most")), "patterns")
        scored = graph.where("not seed").join(small(counts, counts.count()), "pattern")
        values = scored.groupBy("value").agg(F.avg("p").alias("v"), F.count("*").alias("n"), F.max("support").alias("most_support"), F.max_by("most", F.struct("p", "support", "pattern")).alias("k"))
        sure = (F.col("v") >= CONFIDENCE) & ((F.col("n") >= 2) | (F.col("most_support") >= STRONG))
        values = values.select("value", "v", F.when(sure, F.col("k")).alias("k"))
        step = graph.join(values, "value", "left")
        step = scratch.keep(
            step.select("pattern", "value", "seed", F.when(F.col("seed"), F.col("kind")).otherwise(F.col("k")).alias("kind"), F.when(F.col("seed"), 1.0).otherwise(F.coalesce("v", F.lit(0.0))).alias("confidence")), "step"
        )
        scratch.drop(graph)
        graph = step
    return scratch.keep(graph.where("not seed and kind is not null").groupBy("value").agg(F.first("kind").alias("kind")), "found")


def quoted(value: Column) -> Column:
    """A form for value as a word by itself."""
    text = F.replace(value, F.lit(JOIN), F.lit(" "))
    return F.concat(F.lit(rf"(?<![^{SPACE}(\[])\Q"), F.replace(text, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit(rf"\E(?=[.!?)\]]*+(?:[{SPACE}]|\z))"))


def personal_data(docs: DataFrame) -> DataFrame:
    """(row, doc_id, base, spans) for every row of docs (doc_id, text): arrays of (start, kind_no, end, value), sorted.

    base are the entities of the four fixed forms; spans are these, the seeds of secrets and the found values, wherever
    they stand as words in a document that has them in a pattern, unless they overlap one of base; of those that lie
    inside one another the longest counts. Places are code points, end exclusive. A null text is empty; repeated rows
    have the same spans; other columns are ignored; an empty table gives no rows. docs must give the same rows in the
    same order each time it is read, as files do.
    """
    scratch = Scratch(docs.sparkSession, "pii")
    text = cleaned(F.coalesce(F.col("text"), F.lit("")))
    docs = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text.alias("text"))
    t = F.col("text")
    rows = scratch.keep(docs.select("row", "doc_id", entities(t).alias("base"), keys(t).alias("keys"), assigned(t).alias("assigned")), "spans")
    names = scratch.keep(rows.select("row", F.explode("assigned").alias("x")).select("row", "x.name", "x.value", (F.col("x.value").rlike(RANDOM) & ~F.col("x.name").isin(PUBLIC)).alias("random")), "assigned")
    keyed = rows.select("row", F.explode("keys").alias("value"))
    secret = names.where(F.col("random") & (F.length("value") >= LONG)).select("row", "value").unionByName(keyed).distinct()
    secret = scratch.keep(secret, "secrets")
    plain = rows.select(F.explode("base").alias("x")).select(F.replace("x.value", F.lit(" "), F.lit(JOIN)).alias("value"), F.col("x.kind_no").alias("kind"))
    seeds = scratch.keep(plain.unionByName(secret.select("value", F.lit(SECRET).alias("kind"))).groupBy("value").agg(F.min("kind").alias("kind")), "seeds")

    # Patterns of words that seeds stand in, by the documents that have any.
    with_base = rows.where(F.size("base") > 0).select("row", "base")
    based = small(scratch.keep(with_base, "with_base"), with_base.count())
    marks = docs.select("row", "text").join(based, "row", "left").select("row", marked(t, F.coalesce("base", F.array().cast(SPAN))).alias("text"))
    seeded = scratch.keep(with_base.select("row").unionByName(secret.select("row")).distinct(), "seeded")
    near = scratch.keep(marks.join(small(seeded, seeded.count()), "row", "left_semi"), "near")
    stands = in_context(near).join(small(seeds.select("value"), seeds.count()), "value")
    stands = stands.groupBy("pattern", "value").agg(F.count("*").alias("times"))
    stands = stands.groupBy("pattern").agg(F.count("*").alias("support"), F.sum("times").alias("seeds"))
    slots = scratch.keep(stands.where(F.col("support") >= SUPPORT).select("pattern", "seeds"), "slots")

    def selective(slots: DataFrame, n: int, places: DataFrame) -> DataFrame:
        """Those of slots where seeds make up SHARE of their places (pattern) at least."""
        whole = places.join(small(slots, n), "pattern").groupBy("pattern", "seeds").agg(F.count("*").alias("times"))
        return scratch.keep(whole.where(F.col("seeds") >= SHARE * F.col("times")).select("pattern", "seeds"), "selective")

    # In the documents with seeds first: where seeds are too few of these places, they are too few of all.
    n = slots.count()
    if n:
        slots = selective(slots, n, in_context(near))
        n = slots.count()
    edges = names.select(F.concat(F.lit("N "), "name").alias("pattern"), "value").unionByName(names.where("random").select(F.lit("F").alias("pattern"), "value"))
    placed = names.select("row", "value")
    if n:
        slots = selective(slots, n, in_context(marks, slots, n))
        n = slots.count()
    if n:
        seen = scratch.keep(in_context(marks, slots, n).select("row", "pattern", "value").distinct(), "seen")
        edges, placed = edges.unionByName(seen.select("pattern", "value")), placed.unionByName(seen.select("row", "value"))
    found = bootstrap(edges.distinct(), seeds, scratch)
    hits = placed.join(small(found, found.count()), "value").unionByName(secret.select("value", "row", F.lit(SECRET).alias("kind")))
    hits = scratch.keep(hits.groupBy("row").agg(F.collect_set(F.struct("value", "kind")).alias("hits")), "hits")
    hits = small(hits, hits.count())
    none = F.array().cast(SPAN)
    more = docs.select("row", "text").join(hits, "row").select("row", F.flatten(F.transform("hits", lambda h: spans_of(t, quoted(h["value"]), h["kind"]))).alias("more"))
    out = rows.select("row", "doc_id", "base").join(more, "row", "left").withColumn("more", F.coalesce("more", none))
    clear = F.filter("more", lambda x: ~F.exists("base", lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"])))
    out = out.withColumn("more", clear)
    inner = lambda x: F.exists("more", lambda y: (y["start"] <= x["start"]) & (x["end"] <= y["end"]) & (y["end"] - y["start"] > x["end"] - x["start"]))
    more = F.array_distinct(F.filter("more", lambda x: ~inner(x)))
    return out.select("row", "doc_id", "base", F.array_sort(F.concat("base", more)).alias("spans"))


def span_list(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(kinds, x["kind_no"] + 1), x["start"], x["end"])), ",")


def redacted(docs: DataFrame) -> DataFrame:
    """docs with each personal span of text replaced by its kind in angle brackets; n_chars follows, if there is one.

    Overlapping spans are replaced together, by the kind of the first. All other columns stay. docs must give the same
    rows in the same order each time it is read, as files do.
    """
    found = personal_data(docs).where(F.size("spans") > 0).select(F.col("row").alias("_row"), F.col("spans").alias("_spans"))
    found = Scratch(docs.sparkSession, "redact").keep(found, "found")
    if found.count() <= BROADCAST_ROWS // 10:
        found = F.broadcast(found)
    rows = docs.withColumn("_row", F.monotonically_increasing_id())
    kinds = F.array(*(F.lit(f"<{k}>") for k in KINDS))
    text = F.col("text")
    done = F.aggregate(
        "_spans",
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda acc, x: F.struct(
            F.when(x["start"] < acc["at"], acc["out"]).otherwise(F.concat(acc["out"], F.substr(text, acc["at"] + 1, x["start"] - acc["at"]), F.element_at(kinds, x["kind_no"] + 1))).alias("out"),
            F.greatest(acc["at"], x["end"]).alias("at"),
        ),
        lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1, F.length(text))),
    )
    out = rows.join(found, "_row", "left").withColumn("text", F.when(F.col("_spans").isNull(), text).otherwise(done))
    out = out.select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out
