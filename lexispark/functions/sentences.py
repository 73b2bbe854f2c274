"""Token and sentence types, and projections of token arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN = (
    "struct<id: int, form: string, lemma: string, upos: string, xpos: string, feats: map<string, string>, head: int, "
    "deprel: string, deps: string, misc: map<string, string>>"
)
COLLOCATION = "struct<rel: string, ids: array<int>>"


def feat(t: Column, name: str, default: str | None = None) -> Column:
    return F.coalesce(F.try_element_at(t["feats"], F.lit(name)), F.lit(default))


def misc(t: Column, name: str, default: str | None = None) -> Column:
    return F.coalesce(F.try_element_at(t["misc"], F.lit(name)), F.lit(default))


def form_text(t: Column) -> Column:
    return t["form"]


def lemma_text(t: Column) -> Column:
    """The compound verb, or else the lemma, or else the form; empty strings don't count."""
    some = lambda c: F.nullif(c, F.lit(""))
    return F.coalesce(some(misc(t, "CompoundVerb")), some(t["lemma"]), t["form"])


def space_after(t: Column) -> Column:
    return misc(t, "SpaceAfter", "Yes") != "No"


def text(tokens: Column) -> Column:
    """The sentence's text: tokens and the spaces between them."""
    joined = F.array_join(F.transform(tokens, lambda t: F.concat(t["form"], F.when(space_after(t), " ").otherwise(""))), "")
    return F.rtrim(joined)


def hit_set(meta: Column) -> Column:
    """Token numbers in the metadata key hits, sorted and distinct."""
    return F.array_sort(F.array_distinct(F.coalesce(F.from_json(F.try_element_at(meta, F.lit("hits")), "array<int>"), F.array().cast("array<int>"))))


def gdex_score(meta: Column) -> Column:
    return F.coalesce(F.try_element_at(meta, F.lit("gdex")).try_cast("double"), F.lit(0.0))


def collocations_json(collocations: Column) -> Column:
    """[["REL", 1, 2], ...]"""
    one = lambda c: F.concat(F.lit('["'), c["rel"], F.lit('", '), F.array_join(c["ids"].cast("array<string>"), ", "), F.lit("]"))
    return F.concat(F.lit("["), F.array_join(F.transform(collocations, one), ", "), F.lit("]"))


def parse_collocations(json: Column) -> Column:
    rows = F.from_json(json, "array<array<string>>")
    return F.transform(rows, lambda r: F.struct(r[0].alias("rel"), F.slice(r, F.lit(2), F.size(r)).cast("array<int>").alias("ids")))


def hit_collocs(collocations: Column, hits: Column) -> Column:
    """(rel, id): of the first two members of a collocation that has a hit, those that are none."""
    found = F.transform(collocations, lambda c: F.struct(c["rel"].alias("rel"), F.slice(c["ids"], 1, 2).alias("two")))
    found = F.filter(found, lambda c: F.arrays_overlap(c["two"], hits))
    return F.flatten(F.transform(found, lambda c: F.transform(F.array_except(c["two"], hits), lambda i: F.struct(c["rel"].alias("rel"), i.alias("id")))))


def marked_text(tokens: Column, hits: Column, collocates: Column | None = None) -> Column:
    """Text with <t> around hits and <c> around collocates; a token that is both is a hit."""
    collocates = F.array().cast("array<int>") if collocates is None else collocates

    def one(t: Column) -> Column:
        tag = lambda n: F.concat(F.lit(f"<{n}>"), t["form"], F.lit(f"</{n}>"))
        shown = F.when(F.array_contains(hits, t["id"]), tag("t")).when(F.array_contains(collocates, t["id"]), tag("c")).otherwise(t["form"])
        return F.concat(shown, F.when(space_after(t), " ").otherwise(""))

    return F.rtrim(F.array_join(F.transform(tokens, one), ""))


def token_offsets(tokens: Column) -> Column:
    """(id, start, end) of every token in the sentence's text, end exclusive."""
    return F.aggregate(
        tokens,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<id: int, start: int, end: int>>").alias("out")),
        lambda a, t: F.struct(
            (a["at"] + F.length(t["form"]) + F.when(space_after(t), 1).otherwise(0)).alias("at"),
            F.array_append(a["out"], F.struct(t["id"].alias("id"), a["at"].alias("start"), (a["at"] + F.length(t["form"])).alias("end"))).alias("out"),
        ),
        lambda a: a["out"],
    )


def target_window(tokens: Column, target: Column, size: int) -> Column:
    """At most size tokens with the target (place from 1) as near to the middle as the ends allow."""
    start = F.greatest(F.lit(1), F.least(target - size // 2, F.size(tokens) - size + 1))
    return F.slice(tokens, start, F.lit(size))
