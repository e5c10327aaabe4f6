"""Fuzzy line deduplication in DataFrame and SQL functions alone.

A line is compared by its distinct character shingles: runs of WIDTH UTF-16 units of the trimmed, lower-cased line. Each shingle is hashed
once to 64 bits; the bits of this hash from 3j on, j = 0 to 12, are 13 orders, and the least values in them the line's minima. (The leading bits
decide a minimum, and orders overlap little enough there: simulated sets of 5 to 1,500 shingles reach the recall of independent orders.)
The 13 bands of 4 minima are the lines of the projective plane of order 3, any two of which share one minimum: nearly
the recall of bands with minima of their own, for a quarter of the minima. A pair of similarity s shares a band with a probability of 0.976 at 0.8, 0.993 at 0.85 and 0.998 from 0.9 on.
Candidates are verified by the exact Jaccard similarity of their shingle sets, and links go through distributed union-find. One line of
each component stays: its first occurrence.

All minima of a line come from one aggregation, BLOCK shingles an exploded row, which also makes equal lines one; no text is shuffled for it.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ambermill.functions.columns import fresh_names
from ambermill.llm.common import components, one_level_maps, open_lists, small, stash, stash_plain, unstash

WIDTH = 8
MINIMA, BAND = 13, (0, 1, 3, 9)  # every difference of two minima occurs once modulo 13, which makes the shifted bands a projective plane
BLOCK = 16
SKETCH = 16  # longs
SIDE_BYTES = 8 * (SKETCH + MINIMA + 6)  # of a row of cross_pairs() at most
ENDS = 8  # halvings
BLANK = " \t\r\x0b\x0c"
ROUNDS, HEADS = 3, 4
FEW = 8  # pairs a row of all lists; open lists of no more than that are compared without a further round of heads


def normal(line: Column) -> Column:
    """Trimmed and lower-cased. Trimming by a set of characters lists the places of all characters, so only lines that need it are trimmed."""
    blank = functools.reduce(Column.__or__, [end(line, F.lit(c)) for c in BLANK for end in (F.startswith, F.endswith)])
    return F.lower(F.when(blank, F.trim(line, F.lit(BLANK))).otherwise(line))


def units(line: Column) -> Column:
    """The line as UTF-16 bytes: two for each unit, so that a shingle is found without counting characters."""
    return F.encode(line, "UTF-16BE")


def last_place(line_units: Column, width: int) -> Column:
    """The byte, from 1, at which the last shingle starts. A line shorter than a shingle is one by itself."""
    return F.greatest(F.octet_length(line_units) - (2 * width - 1), F.lit(1))


def block_of_shingles(line_units: Column, at: Column, last: Column, width: int, block: int = BLOCK) -> list[Column]:
    """Hashes of the shingles from byte `at` on; beyond the end the last one repeats, which changes no set."""
    return [F.xxhash64(F.substring(line_units, F.least(at + 2 * k, last), F.lit(2 * width))) for k in range(block)]


def occurrences(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """doc_id, text_hash, line_no, line (normalised, may be blank), line_id and check: two independent hashes of the line."""
    body = F.col(f"`{text}`")
    # hashed in a step of its own: beside posexplode the whole text would be hashed again for each of its lines
    hashed = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(body).alias("text_hash"), body.alias("_text"))
    rows = hashed.select("doc_id", "text_hash", F.posexplode(F.split("_text", "\n")).alias("line_no", "_line"))
    rows = rows.select("doc_id", "text_hash", "line_no", normal(F.col("_line")).alias("line"))
    return rows.select("*", F.xxhash64("line").alias("line_id"), F.xxhash64(F.lit(1), F.col("line")).alias("check"))


def signatures(lines: DataFrame, width: int) -> DataFrame:
    """id, copies (occurrences) and the keys of its bands, from (line_id, line)."""
    cut = lines.select("line_id", units(F.col("line")).alias("u")).select("line_id", "u", last_place(F.col("u"), width).alias("last"))
    cut = cut.select("line_id", "u", "last", F.explode(F.sequence(F.lit(1), F.col("last"), F.lit(2 * BLOCK))).alias("i"))
    hashed = cut.select("line_id", "i", *[h.alias(f"h{k}") for k, h in enumerate(block_of_shingles(F.col("u"), F.col("i"), F.col("last"), width))])
    least = [F.min(F.least(*[F.shiftleft(f"h{k}", 3 * j) if j else F.col(f"h{k}") for k in range(BLOCK)])).alias(f"m{j}") for j in range(MINIMA)]
    keys = F.array(*[F.xxhash64(F.lit(n), *[F.col(f"m{(n + d) % MINIMA}") for d in BAND]) for n in range(MINIMA)])
    return hashed.groupBy("line_id").agg(F.count_if(F.col("i") == 1).alias("copies"), *least).select(F.col("line_id").alias("id"), "copies", keys.alias("keys"))


def central_heads(lists: DataFrame) -> DataFrame:
    """key, head of the lists (key, id, c) of more than two lines: the line whose lists are longest in sum, so one that agrees with many others.
    Among copies edited apart from each other it is near their source, and comparing each line with it joins most of them."""
    weights = lists.groupBy("id").agg(F.sum("c").alias("w"))
    return lists.where("c > 2").join(weights, "id").groupBy("key").agg(F.max(F.struct("w", "id"))["id"].alias("head"))


def shingle_blocks(texts: DataFrame, line: str, width: int) -> DataFrame:
    """texts with `s`, arrays of BLOCK shingles, a row each."""
    cut = texts.withColumn("u", units(F.col(line))).drop(line).withColumn("last", last_place(F.col("u"), width))
    cut = cut.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("last"), F.lit(2 * BLOCK))))
    return cut.withColumn("s", F.array(*block_of_shingles(F.col("u"), F.col("i"), F.col("last"), width))).drop("u", "last", "i")


def sketches(texts: DataFrame, width: int) -> DataFrame:
    """id, n (distinct shingles) and w0, w1, ...: the parity of the shingles that fall on each of 64 * SKETCH bits."""
    sets = shingle_blocks(texts.select("line_id", "line").repartition("line_id"), "line", width).groupBy("line_id").agg(F.array_distinct(F.flatten(F.collect_list("s"))).alias("s"))
    each = sets.select(F.col("line_id").alias("id"), F.explode("s").alias("h"))
    marked = each.select("id", F.pmod("h", F.lit(SKETCH)).alias("k"), F.expr("shiftleft(1L, cast(shiftright(h, 32) & 63 as int))").alias("bit"))
    words = marked.groupBy("id", "k").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("bit").alias("w"))
    return words.groupBy("id").agg(F.sum("n").alias("n"), *[F.coalesce(F.max(F.when(F.col("k") == w, F.col("w"))), F.lit(0)).alias(f"w{w}") for w in range(SKETCH)])


def with_ends(pairs: DataFrame) -> DataFrame:
    """pairs (ua, ub, ...) with p and q, how many units they surely have in common at the start and at the end: to within a 2**ENDS part of
    the shorter one, and p + q at most its length."""
    out = pairs.withColumn("p", F.lit(0)).withColumn("q", F.lit(0)).withColumn("m", F.expr("least(octet_length(ua), octet_length(ub)) div 2").cast("int"))
    for end in ("p", "q"):
        for k in range(1, ENDS + 1):
            step = f"shiftright(m, {k})"
            at = {"p": "2 * p + 1", "q": f"octet_length(u?) - 2 * (q + {step}) + 1"}[end]
            parts = [f"substring(u{x}, {at.replace('?', x)}, 2 * {step})" for x in "ab"]
            out = out.withColumn(end, F.expr(f"{end} + if({parts[0]} = {parts[1]}, {step}, 0)"))
        out = out.withColumn("m", F.col("m") - F.col(end))
    return out.drop("m")


def similar(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose shingle sets have 100 * intersection >= percent * union; total is the sum of both sizes. Lines travel; their
    shingles are hashed where they meet, unless so few lie between what both have in common at the ends that the pair is linked in any case."""
    side = lambda x: texts.select(F.col("line_id").alias(x), F.col("line").alias(f"l{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "total", units(F.col("la")).alias("ua"), units(F.col("lb")).alias("ub"))
    cut = with_ends(both.repartition("a", "b"))
    cut = cut.select("*", last_place(F.col("ua"), width).alias("za"), last_place(F.col("ub"), width).alias("zb"))
    shared = sum((F.greatest(F.col(x) - (width - 1), F.lit(0)) for x in "pq"), F.lit(0))
    between = F.expr("(za + 1) div 2 + (zb + 1) div 2") - 2 * shared
    cut = cut.withColumn("sure", between * (100 + percent) <= F.col("total") * (100 - percent))
    end = F.when(F.col("sure"), F.lit(1)).otherwise(F.greatest("za", "zb"))
    cut = cut.select("*", F.explode(F.sequence(F.lit(1), end, F.lit(2 * BLOCK))).alias("i"))
    sides = [F.array(*block_of_shingles(F.col(f"u{x}"), F.col("i"), F.col(f"z{x}"), width)).alias(f"s{x}") for x in "ab"]
    sets = cut.select("a", "b", "total", "sure", *sides).groupBy("a", "b", "total", "sure").agg(*[F.flatten(F.collect_list(f"s{x}")).alias(f"s{x}") for x in "ab"])
    return sets.where(F.col("sure") | (F.size(F.array_intersect("sa", "sb")) * (100 + percent) >= F.col("total") * percent)).select("a", "b")


def may_link(percent: int) -> Column:
    """Whether sides a and b may be linked; only pairs that can't be are refused. Each bit in which sketches differ stands for a
    shingle that only one side has, and linked sets have at most (1 - s) / (1 + s) of both sizes together of those."""
    apart = sum((F.bit_count(F.col(f"w{k}a").bitwiseXOR(F.col(f"w{k}b"))) for k in range(SKETCH)), F.lit(0))
    return apart * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent)


def drawn_heads(lists: DataFrame, turn: int) -> DataFrame:
    """key, head, head_root of open lists: HEADS lines of each, drawn by hash anew each turn, those of grown components first. Lists of much the
    same lines draw much the same heads."""
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.col("grown").desc(), F.xxhash64("id", F.lit(turn)), "id"))
    return lists.withColumn("rank", rank).where(F.col("rank") <= HEADS).select("key", F.col("id").alias("head"), F.col("root").alias("head_root"))


def pairs_of_lists(lists: DataFrame) -> int:
    return lists.groupBy("key").agg(F.count(F.lit(1)).alias("c")).agg(F.coalesce(F.sum(F.expr("c * (c - 1) div 2")), F.lit(0))).first()[0]


def cross_pairs(sides: DataFrame, percent: int) -> DataFrame:
    """a, b, na, nb: the lines of open lists that are of different components and may be linked, each pair in the first list it shares.

    A shuffle would bring a long list into one partition, which Spark then splits on both sides: tasks by the square of the list's bytes, thousands
    of them, whose statuses and metrics all meet on the driver. So where they are small, one side is dealt out line by line
    and the other is broadcast.
    """
    half = lambda x: sides.select(*[F.col(c).alias(x if c == "id" else c + x) for c in sides.columns])
    left, right = half("a"), half("b")
    if (whole := small(right, SIDE_BYTES)) is not right:
        left, right = left.repartition("a", "keya"), whole
    apart = (F.col("keya") == F.col("keyb")) & (F.col("roota") != F.col("rootb")) & (F.col("a") < F.col("b"))
    return left.join(right, apart & may_link(percent) & ~F.arrays_overlap("earliera", "earlierb")).select("a", "b", "na", "nb")


def line_components(lines: DataFrame, width: int = WIDTH, percent: int = 80) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(node, root) over line ids for lines that are near another, the texts compared, and the ids of lines that occur
    more than once. lines: line_id, check, line, an occurrence each.

    Each line is first compared with the central head of each of its lists, then, while lists that still hold several components have many pairs and rounds
    settle them, with a few drawn heads; so large groups become components in steps that grow with their size. What is open then is compared across components. Sketches
    rule pairs out beforehand. So every pair of a list is verified, ruled out or in one component already. That holds for a list of two lines once
    it is compared with its head, and for one of up to HEADS + 1 lines once it is compared with drawn heads; such lists are left out from then on.
    """
    signed = stash_plain(signatures(lines, width), "signed")
    repeated = stash(signed.where("copies > 1").select(F.col("id").alias("line_id")), "repeated")
    keyed = signed.select("id", F.explode("keys").alias("key"))
    counts = stash(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "counts")
    lists = stash(keyed.join(small(counts, 16), "key"), "lists")
    ids = stash(lists.select(F.col("id").alias("line_id")).distinct(), "ids")
    texts = stash(lines.select("line_id", "check", "line").join(small(ids, 8), "line_id", "left_semi").dropDuplicates(["line_id"]), "texts")
    sketch = stash_plain(sketches(texts, width), "sketch")
    side = lambda x: sketch.select(*[F.col(c).alias(x if c == "id" else c + x) for c in sketch.columns])
    total = (F.col("na") + F.col("nb")).alias("total")
    union = lambda tables: functools.reduce(DataFrame.unionByName, tables)
    proven, tried, roots, open_, settled = [], [], None, None, 2
    few, left = FEW * lists.count(), float("inf")
    for turn in range(ROUNDS):
        if turn == 0:
            heads = stash(central_heads(lists), "heads")
            two = lists.where("c = 2").groupBy("key").agg(F.min("id").alias("head"), F.max("id").alias("id"))
            met = lists.join(small(heads, 16), "key").where("id <> head").select("head", "id").unionByName(two.select("head", "id"))
        else:
            heads, settled = stash(drawn_heads(open_, turn), "heads"), HEADS + 1
            met = open_.join(small(heads, 24), "key").where("root <> head_root")
        met = met.select(F.least("head", "id").alias("a"), F.greatest("head", "id").alias("b")).distinct()
        tried.append(stash(met.join(side("a"), "a").join(side("b"), "b").where(may_link(percent)).select("a", "b", total), "tried"))
        proven.append(stash(similar(tried[-1], texts, width, percent), "proven"))
        linked = not proven[-1].isEmpty()
        if linked:
            roots = components(union(proven))
        unstash(heads, *([open_] if open_ else []))
        open_ = open_lists(lists.where(F.col("c") > settled).select("key", "id"), roots)
        last, left = left, pairs_of_lists(open_) if linked and turn + 1 < ROUNDS else 0
        if left <= few or left > last / 2:  # few are open, or the round has settled few
            break
    unstash(counts, lists)
    if not open_.isEmpty():
        own = stash(open_.select("id").distinct(), "own")
        keys = signed.drop("copies").join(small(own, 8), "id", "left_semi")
        sides = open_.drop("grown").join(keys.join(sketch, "id"), "id")
        # a band's key tells the band, so a pair is made in the first of its lists only: where no earlier key is shared
        earlier = F.slice("keys", F.lit(1), F.array_position("keys", F.col("key")).cast("int") - 1)
        sides = stash(sides.withColumn("earlier", earlier).drop("keys"), "sides")
        pairs = stash(cross_pairs(sides, percent).select("a", "b", total).join(union(tried).select("a", "b"), ["a", "b"], "left_anti"), "pairs")
        if not pairs.isEmpty():
            roots = components(union([*proven, similar(pairs, texts, width, percent)]))
        unstash(own, sides, pairs)
    unstash(signed, ids, sketch, open_, *tried, *proven)
    if roots is None:
        roots = texts.where(F.lit(False)).select(F.col("line_id").alias("node"), F.col("line_id").alias("root"))
    return roots, texts, repeated


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = WIDTH, percent: int = 80) -> DataFrame:
    """One row a line: doc_id, text_hash, line_no (from 0), line_id, component (of lines), kept.

    The first occurrence of a component, by doc_id (NULL first), hash of the document's text and line number, is kept. Blank lines are not
    compared and have no row; NULL and empty texts have none at all. Lines shorter than a shingle equal only themselves. Rows that repeat an id and
    text count as one document, whose lines stay or go together; rows of one id with different texts (or of NULL ids) are different
    documents. Lines are told apart by two 64-bit hashes; line_id and component show one. An empty table gives an empty one; further columns play no part.
    """
    with one_level_maps(docs.sparkSession):
        return _dedup_lines(docs, text, doc_id, width, percent)


def _dedup_lines(docs: DataFrame, text: str, doc_id: str, width: int, percent: int) -> DataFrame:
    lines = stash_plain(occurrences(docs, text, doc_id), "lines").where("line <> ''")
    roots, texts, repeated = line_components(lines, width, percent)
    checks = texts.select("line_id", "check")
    near = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    near = near.join(checks.withColumnRenamed("line_id", "node"), "node").join(checks.select(F.col("line_id").alias("root"), F.col("check").alias("root_check")), "root")
    near = stash(near.select(F.col("node").alias("line_id"), "check", "root", "root_check"), "near")
    named = lines.drop("line").join(small(near, 32), ["line_id", "check"], "left")
    named = named.withColumn("component", F.coalesce("root", "line_id")).withColumn("component_check", F.coalesce("root_check", "check")).drop("root", "root_check")
    component = ["component", "component_check"]
    shared = stash(repeated.unionByName(near.select("line_id")).distinct(), "shared")
    firsts = named.join(small(shared, 8), "line_id", "left_semi").groupBy(*component).agg(F.min(F.struct("doc_id", "text_hash", "line_no")).alias("_first"))
    firsts = stash(firsts, "firsts")
    unstash(repeated, texts, shared)
    out = named.join(small(firsts, 48), component, "left")
    same = F.col("_first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("_first.text_hash") == F.col("text_hash")) & (F.col("_first.line_no") == F.col("line_no"))
    return out.select("doc_id", "text_hash", "line_no", "line_id", "component", (F.col("_first").isNull() | same).alias("kept"))


def drop_duplicate_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **params) -> DataFrame:
    """docs with the lines that dedup_lines doesn't keep taken out of the text; all columns and rows stay. A NULL text stays NULL."""
    id_, hash_, gone_, lines_ = fresh_names(docs.columns, "_id", "_hash", "_gone", "_lines")
    body = F.col(f"`{text}`")
    gone = dedup_lines(docs, text, doc_id, **params).where("not kept")
    gone = gone.groupBy(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_)).agg(F.collect_set("line_no").alias(gone_))
    joined = docs.join(gone, F.col(f"`{doc_id}`").eqNullSafe(F.col(id_)) & (F.xxhash64(body) == F.col(hash_)), "left")
    cut = joined.withColumn(lines_, F.when(F.col(gone_).isNotNull(), F.split(body, "\n")))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines_) - 1), F.col(gone_))
    rest = F.array_join(F.transform(left, lambda i: F.get(F.col(lines_), i)), "\n")
    new = F.when(F.col(gone_).isNull(), body).otherwise(rest)
    return cut.select(*[new.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
