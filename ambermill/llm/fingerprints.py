"""Document fingerprints: a Merkle tree over paragraphs and sections, in SQL functions alone.

A section is a line of the text; its paragraphs are clauses: the shortest runs that end in punctuation before white space or at the line's end,
cut after 160 characters where there is none. A paragraph's node is a hash of its text, a section's of
its paragraphs' nodes, the root's of the sections' nodes. The fingerprint writes the tree from the root down:

    <root>:<section>=<paragraph>.<paragraph>/<section>=...

Equal texts have equal roots; where roots differ, sections and then paragraphs that differ tell where.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

NODE = 16
PARAGRAPH = r"(?s).{1,160}?(?:[\p{P}\p{S}](?=\s|$)\s*|$)|(?s).{1,160}"
ROWS_A_BUCKET = 2_000
MOST_BUCKETS = 20_000


def node(text: Column) -> Column:
    return F.substring(F.sha2(text, 256), 1, NODE)


def sections(text: Column) -> Column:
    """array<struct<node, paragraphs array<string>>> of a text; none for an empty one."""
    lines = F.when(F.length(text) > 0, F.split(text, "\n")).otherwise(F.array().cast("array<string>"))
    leaves = F.transform(lines, lambda s: F.transform(F.regexp_extract_all(s, F.lit(PARAGRAPH), F.lit(0)), node))
    return F.transform(leaves, lambda p: F.struct(node(F.array_join(p, ".")).alias("node"), p.alias("paragraphs")))


def written(tree: Column) -> Column:
    root = F.sha2(F.array_join(F.transform(tree, lambda s: s["node"]), "/"), 256)
    return F.concat(root, F.lit(":"), F.array_join(F.transform(tree, lambda s: F.concat(s["node"], F.lit("="), F.array_join(s["paragraphs"], "."))), "/"))


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text column; NULL counts as empty."""
    return written(sections(F.coalesce(text, F.lit(""))))


def paragraph_nodes(print_: Column) -> Column:
    """Distinct paragraph nodes of a fingerprint."""
    tree = F.split(F.substring_index(print_, ":", -1), "/")
    return F.array_distinct(F.filter(F.flatten(F.transform(tree, lambda s: F.split(F.substring_index(s, "=", -1), r"\."))), lambda p: F.length(p) > 0))


def likeness(a: Column, b: Column) -> Column:
    """Dice coefficient of two arrays of paragraph nodes: 1 for equal ones (both empty too), 0 if they share none."""
    total = F.size(a) + F.size(b)
    return F.when(total == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(a, b)) / F.greatest(total, F.lit(1)))


def differing_paragraphs(a: Column, b: Column) -> Column:
    """array<struct<section, paragraph>>: the places, counted from 0, at which two fingerprints hold different paragraphs, or only one holds any.

    Places are compared in order, so a paragraph put in makes the following ones of its section differ, and a line put in the following sections.
    Nothing is looked at below equal roots, nor below equal sections. a and b are columns, not expressions.
    """
    mine, other = (F.filter(F.split(F.substring_index(x, ":", -1), "/"), lambda s: s != "") for x in (a, b))
    both = F.arrays_zip(mine.alias("mine"), other.alias("other"))
    places = F.flatten(
        F.transform(
            both,
            lambda s, i: F.transform(
                F.filter(
                    F.transform(
                        F.arrays_zip(_paragraphs(s.getField("mine")).alias("mine"), _paragraphs(s.getField("other")).alias("other")),
                        lambda p, j: F.struct(i.alias("section"), j.alias("paragraph"), p.getField("mine").eqNullSafe(p.getField("other")).alias("same")),
                    ),
                    lambda p: ~p.getField("same") & ~s.getField("mine").eqNullSafe(s.getField("other")),
                ),
                lambda p: F.struct(p.getField("section").alias("section"), p.getField("paragraph").alias("paragraph")),
            ),
        )
    )
    nothing = F.array().cast("array<struct<section:int,paragraph:int>>")
    return F.when(F.substring_index(a, ":", 1) == F.substring_index(b, ":", 1), nothing).otherwise(places)


def _paragraphs(section: Column) -> Column:
    return F.when(section.isNull(), F.array().cast("array<string>")).otherwise(F.filter(F.split(F.substring_index(section, "=", -1), r"\."), lambda p: p != ""))


def with_next(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, text and next_text: the text of the next document by falling doc_id (NULL ids last), after the last that of the first.

    Documents are dealt into buckets of about 2,000 by quantiles of doc_id (at most 20,000 of them on the driver), and looked ahead
    in there; the last of a bucket gets the first text of the next one. Texts are shuffled once. Rows with the same id are ordered by text.
    doc_id must be an integer: buckets and order then agree.
    """
    if not isinstance(docs.schema[doc_id].dataType, T.IntegralType):
        raise TypeError(f"{doc_id} must be an integer, not {docs.schema[doc_id].dataType.simpleString()}")
    own = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = own.count()
    n = max(1, min(MOST_BUCKETS, rows // ROWS_A_BUCKET))
    bounds: list[int] = []
    if n > 1:
        cuts = own.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], max(10_000, 10 * n)).alias("c")).first()["c"]
        bounds = sorted(set(cuts or []))
    bucket = F.lit(0)
    if bounds:
        known = F.expr(f"array({', '.join(f'{int(b)}L' for b in bounds)})")
        steps = F.array(*[F.lit(1 << k) for k in range(len(bounds).bit_length() - 1, -1, -1)])
        bucket = F.aggregate(steps, F.lit(0), lambda at, s: F.when((at + s <= len(bounds)) & (F.get(known, at + s - 1) <= F.col("doc_id")), at + s).otherwise(at))
    dealt = own.withColumn("_b", bucket)
    w = Window.partitionBy("_b").orderBy(F.col("doc_id").desc_nulls_last(), F.col("text").desc())
    ahead = dealt.select("*", F.lead("text").over(w).alias("_ahead"))
    heads = dealt.groupBy("_b").agg(F.max(F.struct("doc_id", "text"))["text"].alias("_head"))
    present = sorted((r["_b"] for r in dealt.select("_b").distinct().collect()), reverse=True)
    following = list(zip(present, present[1:] + present[:1], strict=True))
    after = docs.sparkSession.createDataFrame(following, "_b int, _next int")
    offered = heads.withColumnRenamed("_b", "_next").join(after, "_next").select("_b", "_head")
    return ahead.join(offered, "_b").select("doc_id", "text", F.coalesce("_ahead", "_head").alias("next_text"))


def edited(text: Column, following: Column) -> Column:
    """The text with its last third (floor) replaced by as many first characters of the following one, or all it has."""
    n = F.char_length(text)
    third = F.floor(n / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - third), F.substring(following, F.lit(1), third))


def fingerprint_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Fingerprints of each text, of its edited form, and their likeness to each other and to the next document's.

    Returns doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next. NULL texts are empty; an empty text has the
    root of no sections, and two such fingerprints are alike (1.0). A single document is its own next one. Repeated rows stay.
    """
    pairs = with_next(docs, text, doc_id).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    made = pairs.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        "edited",
        fingerprint(F.col("text")).alias("fingerprint"),
        fingerprint(F.col("edited")).alias("edited_fingerprint"),
        fingerprint(F.col("next_text")).alias("_next_print"),
    )
    nodes = made.select("*", *[paragraph_nodes(F.col(c)).alias(f"_n{i}") for i, c in enumerate(("fingerprint", "edited_fingerprint", "_next_print"))])
    return nodes.select(
        "doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint",
        likeness(F.col("_n0"), F.col("_n1")).alias("near_edited"), likeness(F.col("_n0"), F.col("_n2")).alias("near_next"),
    )
