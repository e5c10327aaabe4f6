"""Links of lines that are short or repeat themselves."""

import os
import random

import pyarrow.dataset as ds
import pytest

from pyspark.sql import functions as F

from ambermill.llm import common, line_dedup
from ambermill.llm.line_dedup import dedup_lines, drop_duplicate_lines, signatures, similar, units, with_ends


def components_of(spark, lines):
    """The component of each line, each being a document of its own."""
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    return {lines[r.doc_id]: r.component for r in dedup_lines(docs).collect()}


def test_equal_sets_of_unlike_lengths(spark):
    for pair in (["-" * 10, "-" * 40], ["ha" * 20, "ha" * 70], ["a, " * 8 + "a", "a, " * 40 + "a"]):
        of = components_of(spark, [*pair, "a line of other words altogether"])
        assert of[pair[0]] == of[pair[1]] and len(set(of.values())) == 2


def test_recall_on_short_lines(spark):
    """A line and a copy cut at its ends, so that 80 to 90 of 100 shingles are shared; the share of such pairs in a list together."""
    rng, lines, pairs = random.Random(3), [], {}
    for n, cut in ((5, 1), (7, 1), (10, 1), (10, 2), (20, 2), (20, 4), (33, 3), (33, 6)):  # shingles of both together, and of one alone
        for _ in range(400):
            line = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n + 7))
            pairs.setdefault((n, cut), []).append((len(lines), len(lines) + 1))
            lines += [line, line[cut:]]
    signed = signatures(spark.createDataFrame(list(enumerate(lines)), "line_id long, line string"), 8)
    lists = {r.id: set(r["keys"]) for r in signed.collect()}
    for (n, cut), own in pairs.items():
        claimed = 1 - (1 - (1 - cut / n) ** 4) ** 8
        found = sum(bool(lists.get(a, set()) & lists.get(b, set())) for a, b in own) / len(own)
        assert found >= claimed - 0.03, (n, cut, found, claimed)


def test_one_substitution_links_from_79_characters_on(spark):
    """What the README states of edits that 8-unit shingles at 0.8 don't find."""
    line = "".join(random.Random(8).choices("abcdefghijklmnopqrstuvwxyz", k=82))
    for n, linked in ((78, False), (79, True), (82, True)):
        of = components_of(spark, [line[:n], line[:39] + "#" + line[40:n]])
        assert (len(set(of.values())) == 1) == linked, n


def test_one_line_a_component_whatever_the_ids(spark):
    """Rows without an id, or that repeat one with other texts, are documents of their own; rows equal in id and text are one."""
    line = "the very same line of words in all of these documents"
    rows = [(None, f"{line}\nfirst of its kind and like no other"), (None, f"{line}\nsecond, which resembles nothing else at all"), (7, line), (7, f"own start of seven\n{line}"), (7, line)]
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len({(r.doc_id, r.text_hash, r.line_no) for r in got if r.kept and r.component == next(x.component for x in got if x.doc_id == 7 and x.line_no == 0 and not x.kept)}) == 1
    assert sum(r.kept for r in got) == 4


def test_near_copies_of_one_line_become_one_component(spark):
    """Hundreds of copies, each edited in its own place, some of them apart from the source: every link counts."""
    rng = random.Random(11)
    source = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=120))
    lines = [source]
    for _ in range(300):
        x = list(source)
        for at in rng.sample(range(120), rng.choice((1, 1, 2))):
            x[at] = rng.choice("ABC#+-")
        lines.append("".join(x))
    lines = sorted(set(map(str.lower, lines)))
    sets = [{x[i : i + 8] for i in range(len(x) - 7)} for x in lines]
    root = list(range(len(lines)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(lines)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if 10 * n >= 8 * (len(sets[i]) + len(sets[j]) - n):
                root[find(i)] = find(j)
    of = components_of(spark, lines)
    groups = {}
    for i, x in enumerate(lines):
        groups.setdefault(find(i), set()).add(of[x])
    assert sum(len(g) == 1 for g in groups.values()) >= 0.98 * len(groups)
    assert len(set(of.values())) <= len(groups) + 3


@pytest.mark.parametrize("most", [-1, 16 << 20])
def test_long_lines_and_texts_of_many_lines(spark, monkeypatch, most):
    """Also with no broadcast at all, as on tables beyond the bound."""
    monkeypatch.setattr(common, "BROADCAST_BYTES", most)
    rng = random.Random(2)
    long = "".join(rng.choices("abcdef", k=300_000))
    many = "\n".join(f"line number {i} of many, made of {rng.random()}" for i in range(20_000))
    docs = spark.createDataFrame([(1, long), (2, long[:150_000] + "#" + long[150_000:]), (3, many), (4, many)], "doc_id long, text string")
    out = {r.doc_id: r.text for r in drop_duplicate_lines(docs).collect()}
    assert out == {1: long, 2: "", 3: many, 4: ""}


def shingle_set(x):
    return {x[i : i + 8] for i in range(max(1, len(x) - 7))}


def edited_pairs(rng, n):
    """Lines and copies with a few edits, many of them about the threshold; some lines repeat themselves, some have units beyond 16 bits."""
    for i in range(n):
        line = rng.choices("abcdefgh \u00e9\U0001f600" if i % 3 else "ab", k=rng.randrange(1, 240))
        if i % 4 == 0:
            line = line[:6] * 30
        copy = list(line)
        for _ in range(rng.randrange(0, 4)):
            at = rng.randrange(len(copy) + 1)
            copy[at : at + rng.choice((0, 1, 5))] = rng.choices("xyz", k=rng.choice((0, 1, 9)))
        yield "".join(line), "".join(copy)


def test_common_ends_prove_only_true_links(spark):
    """Pairs taken as linked by their ends alone, and those that are hashed, are the linked ones; ends are common and don't overlap."""
    pairs = list(edited_pairs(random.Random(5), 400))
    sets = [[{u[i : i + 16] for i in range(0, max(1, len(u) - 15), 2)} for u in (x.encode("utf-16-be") for x in pair)] for pair in pairs]
    texts = spark.createDataFrame([(2 * i + k, x) for i, pair in enumerate(pairs) for k, x in enumerate(pair)], "line_id long, line string")
    met = spark.createDataFrame([(2 * i, 2 * i + 1, len(a) + len(b)) for i, (a, b) in enumerate(sets)], "a long, b long, total long")
    linked = {2 * i for i, (a, b) in enumerate(sets) if 100 * len(a & b) >= 80 * len(a | b)}
    assert {r.a for r in similar(met, texts, 8, 80).collect()} == linked and 50 < len(linked) < 350
    rows = spark.createDataFrame([(i, *pair) for i, pair in enumerate(pairs)], "i long, la string, lb string")
    found = 0
    for r in with_ends(rows.select("i", units(F.col("la")).alias("ua"), units(F.col("lb")).alias("ub"))).collect():
        a, b = map(bytes, (r.ua, r.ub))
        assert a[: 2 * r.p] == b[: 2 * r.p] and a[len(a) - 2 * r.q :] == b[len(b) - 2 * r.q :] and 2 * (r.p + r.q) <= min(len(a), len(b))
        found += r.p + r.q
    assert found > 0.4 * sum(len(a) for a, _ in pairs)


@pytest.mark.parametrize("few", [-1, 8])
def test_lists_that_are_settled_are_left_out(spark, monkeypatch, few):
    """A list of two is settled by its head, one of up to five by drawn heads; with or without rounds of these, each link of a list is found."""
    rng, lines = random.Random(4), []
    for copies in (1, 1, 1, 3, 4, 9) * 8:
        source = rng.choices("abcdefghijklmnopqrstuvwxyz ", k=110)
        lines.append("".join(source))
        for _ in range(copies):
            copy = list(source)
            for at in rng.sample(range(110), rng.choice((1, 2, 3))):
                copy[at] = "#"
            lines.append("".join(copy))
    lines = sorted({x.strip() for x in lines})
    seen, real = [], line_dedup.open_lists
    monkeypatch.setattr(line_dedup, "open_lists", lambda lists, roots: (seen.append(min([r["count"] for r in lists.groupBy("key").count().collect()], default=99)), real(lists, roots))[1])
    monkeypatch.setattr(line_dedup, "FEW", few, raising=False)
    of = components_of(spark, lines)
    assert seen[0] > 2 and all(n > 5 for n in seen[1:]) and len(seen) == (1 if few > 0 else len(seen))
    keys = {r.id: set(r["keys"]) for r in signatures(spark.createDataFrame(list(enumerate(lines)), "line_id long, line string"), 8).collect()}
    sets = [shingle_set(x) for x in lines]
    links = [(i, j) for i in range(len(lines)) for j in range(i) if keys[i] & keys[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    assert len(links) > 20 and all(of[lines[i]] == of[lines[j]] for i, j in links)


@pytest.mark.parametrize("small", [True, False])
def test_a_long_open_list_takes_few_tasks(spark, monkeypatch, tmp_path, small):
    """Where the sides are small, no partition is split on both sides into tasks by the square of its bytes; the pairs are those of the shuffle."""
    if not small:
        monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    rng, rows = random.Random(9), []
    for i in range(3_000):
        words = [rng.getrandbits(63) for _ in range(line_dedup.SKETCH)] if i % 100 else [1] * line_dedup.SKETCH  # 30 that may be linked with each other
        rows.append((i, 1 if i < 2_900 else i % 7, i // 2, 20, *words, [77] if i in (0, 100) else []))
    kind = "id long, key long, root long, n long, " + "".join(f"w{k} long, " for k in range(line_dedup.SKETCH)) + "earlier array<long>"
    spark.createDataFrame(rows, kind).repartition(30).write.parquet(str(tmp_path / "sides"))
    tight = {"adaptive.coalescePartitions.enabled": "false", "adaptive.advisoryPartitionSizeInBytes": "16k", "adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "adaptive.skewJoin.skewedPartitionFactor": "1.5", "autoBroadcastJoinThreshold": "-1"}
    for k, v in tight.items():
        spark.conf.set(f"spark.sql.{k}", v)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    sc, group = spark.sparkContext, f"few-{small}"
    try:
        sc.setJobGroup(group, group)
        got = [(r.a, r.b) for r in line_dedup.cross_pairs(spark.read.parquet(str(tmp_path / "sides")), 80).collect()]
        jobs = map(sc.statusTracker().getJobInfo, sc.statusTracker().getJobIdsForGroup(group))
        most = max(info.numTasks for j in jobs for s in j.stageIds if (info := sc.statusTracker().getStageInfo(s)))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k in ("files.maxPartitionBytes", *tight):
            spark.conf.unset(f"spark.sql.{k}")
    first = range(0, 2_900, 100)
    assert sorted(got) == [(i, j) for i in first for j in first if i < j and (i, j) != (0, 100)]
    assert most <= 40 if small else most > 100, most


def test_a_text_is_hashed_once_not_once_a_line(spark):
    docs = spark.createDataFrame([(1, "one line\nand another\n\n"), (2, None), (3, "")], "doc_id long, text string")
    got = line_dedup.occurrences(docs, "text", "doc_id")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("xxhash64(text")  # what comes first is done last
    want = docs.select("doc_id", F.xxhash64("text").alias("h")).where("doc_id <> 2")
    assert {(r.doc_id, r.text_hash) for r in got.collect()} == {(r.doc_id, r.h) for r in want.collect()}
    assert sorted((r.doc_id, r.line_no, r.line) for r in got.collect()) == [(1, 0, "one line"), (1, 1, "and another"), (1, 2, ""), (1, 3, ""), (3, 0, "")]


def test_lines_are_trimmed_of_blanks_alone(spark):
    rng = random.Random(6)
    lines = ["", " ", "\t\r\x0b\x0c ", "A", " A", "A\t", "\x0bA b\x0c", " A ", " É ", "\x00 A"] + ["".join(rng.choices(" \t\r\x0b\x0cAé", k=6)) for _ in range(300)]
    got = spark.createDataFrame([(x,) for x in lines], "x string").select("x", line_dedup.normal(F.col("x")).alias("n")).collect()
    assert all(r.n == r.x.strip(" \t\r\x0b\x0c").lower() for r in got)


def test_groups_are_found_without_a_first_map(spark, monkeypatch):
    """While lines are compared Spark's map before the hash table is off; afterwards, and where the session sets it itself, nothing has changed."""
    key, seen, real = common.TWO_LEVELS, [], line_dedup.stash
    monkeypatch.setattr(line_dedup, "stash", lambda df, name="t": (seen.append(spark.conf.get(key)), real(df, name))[1])
    docs = spark.createDataFrame([(1, "a line of many words here"), (2, "a line of many words here")], "doc_id long, text string")
    assert dedup_lines(docs).where("kept").count() == 1
    assert set(seen) == {"false"} and key not in {r.key for r in spark.sql("SET").collect()}
    spark.conf.set(key, "true")
    try:
        dedup_lines(docs)
        assert spark.conf.get(key) == "true"
    finally:
        spark.conf.unset(key)


def test_stars_are_told_by_one_aggregate(spark):
    stars, deep, forked = [(2, 1), (3, 1), (9, 4)], [(2, 1), (3, 2)], [(3, 1), (3, 2)]
    for edges, want in (([], True), (stars, True), (deep, False), (forked, False), (stars + [(4, 1)], False)):
        e = common.stash(spark.createDataFrame(edges, "u long, v long"), "edges")
        spark.sparkContext.setJobGroup(f"stars-{edges}", "stars")
        assert common._stars(e) == want, edges
        stages = {i for j in spark.sparkContext.statusTracker().getJobIdsForGroup(f"stars-{edges}") for i in spark.sparkContext.statusTracker().getJobInfo(j).stageIds}
        assert len(stages) <= 3, (edges, stages)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_hashes_and_texts_are_stored_without_dictionaries(spark, monkeypatch):
    found, real = {}, common.delete_folder

    def seen(session, path):
        at = path.removeprefix("file://")
        for file in ds.dataset(at, format="parquet", partitioning=None).get_fragments() if os.path.isdir(at) else []:
            groups = [g for g in (file.metadata.row_group(i) for i in range(file.metadata.num_row_groups)) if g.num_rows]
            columns = [c for g in groups for c in map(g.column, range(g.num_columns))]
            found.setdefault(file.path.split("/")[-2], set()).update(x for c in columns for x in c.encodings)
        real(session, path)

    monkeypatch.setattr(common, "delete_folder", seen)
    docs = spark.createDataFrame([(i, f"a line of many words here\nand a line {i % 7} of other words") for i in range(50)], "doc_id long, text string")
    with common.scratch(spark):
        kept = {(r.doc_id, r.line_no) for r in dedup_lines(docs).where("kept").collect()}
    assert kept == {(0, 0), *((i, 1) for i in range(7))}
    dictionary = {"PLAIN_DICTIONARY", "RLE_DICTIONARY"}
    assert {"lines", "signed", "sketch"} <= {*found} and all(not found[t] & dictionary for t in ("lines", "signed", "sketch")), found
