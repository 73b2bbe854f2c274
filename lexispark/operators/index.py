"""Index records of sentences: typed fields, pre-analyzed token streams, and postings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import bound, escape_stored, escape_token

GOOD = 0.5
#: Tokens whose running sums are made in one go.
BLOCK = 64


def fields(sentences: DataFrame) -> DataFrame:
    """One record for each sentence (doc_id, sent_no, par_no, gdex, lang, meta): its own fields and its document's.

    Document fields come from the document's first sentence; null and empty ones are left out of the map. A sentence
    without a score has neither gdex_f nor gdex_b.
    """
    first = F.first("meta").over(W.partitionBy("doc_id").orderBy("sent_no"))
    names = {"doc_s": "newdoc id", "bibl_s": "bibl", "url_s": "url", "year_i": "year", "date_dt": "date", "accessed_dt": "accessed", "country_s": "country", "metaarea_s": "metaarea", "area_s": "area", "subarea_s": "subarea"}
    doc = F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.try_element_at(first, F.lit(v)))])
    classes = F.from_json(F.coalesce(F.try_element_at(first, F.lit("textClass")), F.try_element_at(first, F.lit("textClasses"))), "array<string>")
    return sentences.select(
        F.concat_ws("#", "doc_id", "sent_no").alias("id"), F.col("par_no").alias("p_i"), F.col("sent_no").alias("s_i"), F.col("gdex").alias("gdex_f"),
        (F.col("gdex") >= GOOD).alias("gdex_b"), F.col("lang").alias("lang_s"),
        F.map_filter(doc, lambda k, v: F.coalesce(v, F.lit("")) != "").alias("fields"), classes.alias("text_class_ss"),
    )


def offsets(tokens: DataFrame, *keys: str) -> DataFrame:
    """tokens (keys, id, form, space) with start and end in the sentence's text."""
    w = W.partitionBy(*keys).orderBy("id").rowsBetween(W.unboundedPreceding, W.currentRow)
    end = F.sum(F.length("form") + F.col("space").cast("int")).over(w) - F.col("space").cast("int")
    return tokens.withColumn("end", end.cast("int")).withColumn("start", (F.col("end") - F.length("form")).cast("int"))


def postings(tokens: DataFrame, *keys: str) -> DataFrame:
    """(keys, id, term): #lemma, p#upos#lemma and p#xpos#lemma of every token with a lemma; tags in lower case."""
    lemma = F.coalesce("lemma_text", "lemma") if "lemma_text" in tokens.columns else F.col("lemma")
    terms = [F.concat(F.lit("#"), lemma), F.concat(F.lit("p#"), F.lower("upos"), F.lit("#"), lemma)]
    if "xpos" in tokens.columns:
        terms.append(F.when(F.col("xpos").isNotNull(), F.concat(F.lit("p#"), F.lower("xpos"), F.lit("#"), lemma)))
    return tokens.select(*keys, "id", F.explode(F.array_distinct(F.array_compact(F.array(*terms)))).alias("term"))


def entity_postings(entities: DataFrame, tokens: DataFrame, *keys: str) -> DataFrame:
    """e#lemma and e#label#lemma for tokens of entities (keys, label, id), the label as it is."""
    rows = entities.join(tokens.select(*keys, "id", "lemma"), [*keys, "id"])
    terms = F.array(F.concat_ws("#", F.lit("e"), "lemma"), F.concat_ws("#", F.lit("e"), "label", "lemma"))
    return rows.select(*keys, "id", F.explode(terms).alias("term"))


def lemmata(tokens: DataFrame, compounds: DataFrame, *keys: str) -> DataFrame:
    """(keys, id, lemma): a token's lemma, and a compound verb's on its head and on its particle (particle_id)."""
    own = tokens.select(*keys, "id", "lemma")
    head = compounds.select(*keys, "id", F.col("compound_verb").alias("lemma"))
    particle = compounds.select(*keys, F.col("particle_id").alias("id"), F.col("compound_verb").alias("lemma"))
    return own.unionByName(head).unionByName(particle).distinct()


def collocation_postings(collocs: DataFrame, lemmas: DataFrame, *keys: str) -> DataFrame:
    """(keys, id, term): c#rel#l1#l2 and c#rel_#l2#l1 on both members of a collocation, for all their lemmas."""
    l1 = lemmas.select(*keys, F.col("id").alias("n1"), F.col("lemma").alias("l1"))
    l2 = lemmas.select(*keys, F.col("id").alias("n2"), F.col("lemma").alias("l2"))
    rel = F.lower("rel")
    terms = F.array(F.concat_ws("#", F.lit("c"), rel, "l1", "l2"), F.concat_ws("#", F.lit("c"), F.concat(rel, F.lit("_")), "l2", "l1"))
    rows = collocs.join(l1, [*keys, "n1"]).join(l2, [*keys, "n2"])
    rows = rows.select(*keys, "n1", "n2", F.explode(terms).alias("term"))
    return rows.select(*keys, F.explode(F.array("n1", "n2")).alias("id"), "term").distinct()


def _running(xs: Column) -> Column:
    """0, then the running sums of an array of numbers; each step copies what is there."""
    return F.aggregate(xs, F.array(F.lit(0)), lambda sums, x: F.concat(sums, F.array(F.element_at(sums, -1) + x)))


def starts(lengths: Column) -> Column:
    """Sums of all lengths before each one; in blocks of about the root of their number, so long arrays are no square."""
    size = F.greatest(F.lit(BLOCK), F.ceil(F.sqrt(F.size(lengths))).cast("int"))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / size).cast("int")), lambda i: _running(F.slice(lengths, i * size + 1, size)))
    totals = lambda bs: F.slice(_running(F.transform(bs, lambda b: F.element_at(b, -1))), F.lit(1), F.size(bs))
    moved = lambda b, by: F.transform(F.slice(b, F.lit(1), F.size(b) - 1), lambda x: x + by)
    return F.when(F.size(lengths) > BLOCK, F.flatten(bound(blocks, lambda bs: F.zip_with(bs, totals(bs), moved)))).otherwise(_running(lengths))


def stream(tokens: Column) -> Column:
    """Version, stored text, then each token with its place, and its terms at the same position.

    tokens: array of (form, space, terms: sorted array) of one sentence, in its order.
    """

    def shown(first: Column) -> Column:
        def one(t: Column, i: Column) -> Column:
            start = F.get(first, i)
            place = F.concat(F.lit(",s="), start, F.lit(",e="), start + F.length(t["form"]))
            own = F.concat(escape_token(t["form"]), F.lit(",i=1"))
            more = lambda at: F.array_join(F.concat(F.array(F.concat(own, at)), F.transform(t["terms"], lambda x: F.concat(escape_token(x), F.lit(",i=0"), at))), " ")
            return bound(place, lambda at: F.when(F.size(t["terms"]) > 0, more(at)).otherwise(F.concat(own, at)))

        return F.array_join(F.transform(tokens, one), " ")

    text = F.rtrim(F.array_join(F.transform(tokens, lambda t: F.concat(t["form"], F.when(t["space"], " ").otherwise(""))), ""))
    lengths = F.transform(tokens, lambda t: F.length(t["form"]) + t["space"].cast("int"))
    return F.concat(F.lit("1 ="), escape_stored(text), F.lit("= "), bound(bound(lengths, starts), shown))


def pre_analyzed(tokens: DataFrame, terms: DataFrame, *keys: str) -> DataFrame:
    """(keys, text_pre): stream() of tokens (keys, id, form, space) with terms (keys, id, term); both are dealt once, by keys."""
    own = tokens.select(*keys, "id", "form", "space", F.lit(None).cast("string").alias("term"), F.lit(True).alias("own"))
    other = terms.select(*keys, "id", F.lit(None).cast("string").alias("form"), F.lit(None).cast("boolean").alias("space"), "term", F.lit(None).cast("boolean").alias("own"))
    first = lambda c: F.first(c, ignorenulls=True).alias(c)
    rows = own.unionByName(other).repartition(*keys).groupBy(*keys, "id").agg(first("form"), first("space"), F.array_sort(F.collect_set("term")).alias("terms"), first("own"))
    out = rows.where("own").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("id", "form", "space", "terms"))).alias("xs"))
    return out.select(*keys, stream(F.col("xs")).alias("text_pre"))


def add_command(records: DataFrame) -> DataFrame:
    """(value): one JSON document for each record, as an index takes them in batches."""
    return records.select(F.to_json(F.struct(*records.columns)).alias("value"))
