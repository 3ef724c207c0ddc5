"""Resampling, manifest and best-fit packing against brute force, and on odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.test_operators import JSON, LONG, ODD, RANKS, SF, encoder, rows
from webgrove.llm import components, configurations, jaccard, merkle, packing, resampling


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


DOCS = "doc_id long, text string, rank string, leaf string, sequence_id string, _run string, tree string, lang string, source string, n_chars long"


def table_of(spark, texts):
    """Rows with clashing extra columns; languages null, empty and of all sizes."""
    langs = [None, "", "en", "de", "en", "en", "é"]
    return spark.createDataFrame(
        [(i, t, "x", "y", "z", "r", "t", langs[k % 7], None if k % 3 else "s", None if k % 5 == 0 else k) for k, (i, t) in enumerate(texts)], DOCS)


# resampling

def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(brute.LOWER))


def features(text, runs):
    w = words(text)
    return [" ".join(w[i:i + k]) for k in range(1, runs + 1) for i in range(len(w) - k + 1)]


def resampled(docs, target, runs=1, percent=10, min_words=20, buckets=10_000):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s = Counter(bucket(f) for _, t in docs for f in features(t, runs))
    t = Counter(bucket(f) for x in target for f in features(x, runs))
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log(float(t[b] + 1) * (total_s + buckets) / (float(s[b] + 1) * (total_t + buckets)))) for b in range(buckets)]
    out = []
    for doc_id, text in docs:
        got = [gain[bucket(f)] for f in features(text, runs)]
        weight = sum(got) // len(got) if got else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(got), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(text))])
    fit = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for rank, row in enumerate(fit[:percent * len(fit) // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=lambda row: tuple((v is not None, v) for v in row))


COLUMNS = ("doc_id", "n_features", "weight", "score", "rank")


@pytest.mark.parametrize("runs", [1, 3])
def test_resampling_equals_brute_force(spark, runs):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("text").collect()]
    made = resampling.importance_resample(spark.createDataFrame(docs, "doc_id long, text string"),
                                          spark.createDataFrame([(t,) for t in target], "text string"), runs=runs, percent=30)
    assert rows(made, *COLUMNS) == resampled(docs, target, runs, 30)


def test_resampling_of_odd_rows_and_hot_ties(spark, nothing):
    """Nulls, very long texts, a third of all rows alike, a null id that a third of the rows share, no target."""
    same = " ".join(f"w{i}" for i in range(30))
    texts = [*ODD, *[(40, same)] * 60, *[(None, same)] * 60, *[(100 + i, f"{same} {i} {'x ' * (i % 7)}") for i in range(60)]]
    made = resampling.importance_resample(table_of(spark, texts), nothing.select("text"), percent=50)
    assert rows(made, *COLUMNS) == resampled(texts, [], percent=50)
    assert resampling.importance_resample(nothing, nothing).collect() == []
    kept = resampling.drawn(resampling.importance_resample(table_of(spark, texts), nothing, carry=("text", "lang")))
    assert kept.columns == ["doc_id", "text", "lang", "n_features", "weight", "score", "rank"]
    assert [r["rank"] for r in kept.orderBy("rank").collect()] == list(range(1, kept.count() + 1))
    with pytest.raises(ValueError, match="named like"):
        resampling.importance_resample(table_of(spark, texts), nothing, carry=("rank",))


def test_regular_segments_are_even(spark):
    """Equal rows are dealt over the segments: none holds more than about twice its share."""
    table = spark.range(40_000).selectExpr("id % 3 = 0 AS same", "id").selectExpr("if(same, 5, cast(xxhash64(id) % 1000 as long)) AS v", "id").repartition(7)
    runs = resampling.sorted_runs(table, [F.col("v")])
    cuts = resampling.regular_splitters(runs, ("v", "_run", "_at"), 8)
    assert len(cuts) == 7 and cuts == sorted(cuts)
    sizes = Counter()
    for r in runs.select("v", "_run", "_at").collect():
        sizes[sum(tuple(r) >= c for c in cuts)] += 1
    assert max(sizes.values()) <= 2 * 40_000 / 8 and min(sizes.values()) > 0
    ranks = resampling.ranked(table, ("v", "id")).collect()
    assert [(r.v, r.id) for r in sorted(ranks, key=lambda r: r["rank"])] == sorted((r.v, r.id) for r in ranks)
    assert sorted(r["rank"] for r in ranks) == list(range(1, 40_001))


# manifest

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[f] for f in FIELDS)))


def grown(digests, arity):
    """Root of a list of digests, and every one's siblings level by level as (slot, others)."""
    paths, place = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for i, p in enumerate(place):
            start = p - p % arity
            run = digests[start:start + arity]
            paths[i].append((p - start, run[:p - start] + run[p - start + 1:]))
            place[i] = p // arity
        digests = [sha("".join(digests[i:i + arity])) for i in range(0, len(digests), arity)]
    return digests[0], paths


def manifest(docs, arity):
    groups = defaultdict(list)
    for r in docs:
        groups[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: grown([x[2] for x in sorted(groups[g])], arity) for g in order}
    root, upper = grown([trees[g][0] for g in order], arity)
    out = []
    for g, above in zip(order, upper, strict=True):
        subroot, paths = trees[g]
        for (named, doc_id, leaf), path in zip(sorted(groups[g]), paths, strict=True):
            siblings = [h for _, others in path + above for h in others]
            out.append((doc_id if named else None, leaf, subroot, root, sha("".join(siblings))))
    return sorted(out, key=lambda row: tuple((v is not None, v) for v in row))


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_manifest_equals_brute_force(spark, arity):
    """Null and repeated ids, equal rows, null, empty and tiny groups, long texts, clashing names."""
    texts = [*ODD, *[(3, "twice")] * 4, *[(1000 + i, f"text {i % 9}") for i in range(90)]]
    docs = table_of(spark, texts)
    made = merkle.merkle_manifest(docs, fields=FIELDS, arity=arity, carry=("tree", "sequence_id"))
    got = made.withColumn("proof", merkle.proof_digest(F.col("path")))
    assert rows(got, "doc_id", "leaf", "subroot", "root", "proof") == manifest(docs.collect(), arity)
    checked = merkle.verified(made, "leaf")
    assert checked.where("not verified").count() == 0 and checked.where("tree = 't' and sequence_id = 'z'").count() == len(texts)
    forged = merkle.verified(made.withColumn("claimed", F.sha2(F.col("leaf"), 256)), "claimed")
    assert forged.where("verified").count() == 0


def test_manifest_of_few_rows(spark, nothing):
    docs = table_of(spark, [(5, LONG)])
    assert merkle.merkle_manifest(docs.limit(0), fields=FIELDS).collect() == []
    row = merkle.merkle_manifest(docs, fields=FIELDS).first()
    assert row.leaf == row.subroot == row.root == leaf_of(docs.first().asDict()) and row.path == []
    for bad in ({"order": "leaf"}, {"carry": ("root",)}, {"arity": 1}):
        with pytest.raises(ValueError):
            merkle.merkle_manifest(docs, fields=FIELDS, **bad)


def test_manifest_levels_shrink(spark):
    """No level is longer than half the one below it and a group's odd node."""
    docs = spark.range(300).selectExpr("id AS doc_id", "cast(id % 2 AS string) AS lang", "'t' AS text")
    leaves = docs.selectExpr("cast(lang AS long) AS tree", "doc_id div 2 AS idx", "150L AS n", "unhex(sha2(text, 256)) AS digest")
    sizes = [level.count() for level in merkle._levels(leaves, 2, "test")]
    assert sizes == [300, 150, 76, 38, 20, 10, 6, 4, 2]


# best-fit packing

def check_best_fit(docs, pieces, seq_len):
    """Every document's pieces in order, all its ids once, cut only where it is too long; no sequence overfull or with gaps.  Returns the number of sequences."""
    encode = encoder()
    want = Counter()
    for doc_id, text in docs:
        packed = brute.packed_bytes([*encode(text or ""), 0])
        n = len(packed) // 4
        first = n % seq_len or seq_len
        at = [0, *range(first, n, seq_len)]
        for k, (a, b) in enumerate(zip(at, [*at[1:], n], strict=True)):
            want[doc_id, k, a, b - a, zlib.crc32(packed[4 * a:4 * b]), n] += 1
    assert want == Counter((p.doc_id, p.piece, p.start, p.length, p.ids_crc32, p.doc_tokens) for p in pieces)
    held = defaultdict(list)
    for p in pieces:
        held[p.sequence_id].append((p.offset, p.length))
    for parts in held.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= seq_len
    return len(held)


def test_best_fit_packing(spark, nothing):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    made = configurations.best_fit_packing(spark.createDataFrame(docs, "doc_id long, text string"), json_file=JSON, rank_file=RANKS)
    used = check_best_fit(docs, made.collect(), 2048)
    total = sum(r.length for r in made.select("length").collect())
    assert used <= math.ceil(total / 2048) + 2
    repeated = [*ODD, *[(None, "no id here at all and more")] * 40]
    odd = configurations.best_fit_packing(table_of(spark, repeated), json_file=JSON, rank_file=RANKS, seq_len=128, keep_ids=True)
    check_best_fit(repeated, odd.drop("ids").collect(), 128)
    assert all(len(s.ids) == s.used <= 128 for s in packing.sequences(odd).collect())
    assert configurations.best_fit_packing(nothing, json_file=JSON, rank_file=RANKS).collect() == []


def check_plan(counts, plan):
    placed = Counter()
    for times, content in plan:
        assert times > 0 and sum(length * copies for length, copies in content) < len(counts)
        for length, copies in content:
            placed[length] += times * copies
    assert placed == Counter({length: n for length, n in enumerate(counts.tolist()) if n})
    return sum(times for times, _ in plan)


def test_plans_of_random_histograms():
    draw = np.random.default_rng(4)
    for room in (1, 2, 7, 64):
        for scale in (1, 5, 1000):
            counts = np.zeros(room + 1, dtype=np.int64)
            counts[1:] = draw.integers(0, scale + 1, room)
            bound, plan = configurations.sequence_plan(counts)
            used = check_plan(counts, plan)
            assert bound <= used + 1e-6
            check_plan(counts, configurations.best_fit(counts))
            if scale == 1000:
                assert used <= 1.06 * bound + 1


def test_program_beats_decreasing_fit():
    """Lengths of which the greatest should not be filled first: a half and a bit, a quarter and a bit more, and less."""
    counts = np.zeros(101, dtype=np.int64)
    counts[[51, 27, 26, 23]] = 6000, 6000, 6000, 12000
    bound, plan = configurations.sequence_plan(counts)
    used = check_plan(counts, plan)
    assert used <= 1.005 * bound + 1 and used < check_plan(counts, configurations.best_fit(counts))


def test_plan_does_not_grow_with_counts():
    counts = np.zeros(2049, dtype=np.int64)
    counts[[1100, 700, 200, 48]] = 10 ** 9, 10 ** 9, 10 ** 9, 10 ** 9
    bound, plan = configurations.sequence_plan(counts)
    assert check_plan(counts, plan) <= 1.001 * bound and len(plan) < 1000


def test_places():
    plan = [(3, ((5, 2), (3, 1))), (2, ((5, 1),))]
    places = configurations.Places(plan)
    sequence, offset = places.of(np.array([5] * 8 + [3] * 3), np.array([*range(8), *range(3)]))
    assert list(zip(sequence.tolist(), offset.tolist(), strict=True)) == [
        (0, 0), (0, 5), (1, 0), (1, 5), (2, 0), (2, 5), (3, 0), (4, 0), (0, 10), (1, 10), (2, 10)]
    assert places.n_sequences == 5


# similarity join: classes and components

def classes_of(sets, percent):
    """Least position of each set's class, by all pairs."""
    label = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            common = len(np.intersect1d(sets[i], sets[j]))
            if label[i] != label[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label


def test_classes_of_mixed_groups():
    """Groups of near copies that bridge, tiny and large sets, several vector lengths."""
    draw = random.Random(8)
    sets = []
    for _ in range(14):
        base = [draw.getrandbits(64) for _ in range(draw.choice((1, 5, 30, 70, 140, 300)))]
        for _ in range(draw.choice((1, 3, 12))):
            changed = [h if draw.random() > 0.06 else draw.getrandbits(64) for h in base]
            sets.append(np.unique(np.array(changed, dtype=np.uint64)))
            base = changed if draw.random() < 0.5 else base
    sets.sort(key=len)

    def linked(i, j):
        common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        return 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common)

    vectors = [jaccard.count_vector(s, jaccard.groups_of(len(s))) for s in sets]
    want = classes_of(sets, 75)
    assert jaccard.classes_in(vectors, [len(s) for s in sets], 75, linked).tolist() == want and len(set(want)) > 14
    bound = jaccard.classes_in(vectors, [len(s) for s in sets], 75).tolist()
    assert all(bound[i] == bound[j] for i in range(len(sets)) for j in range(i) if want[i] == want[j])


def test_a_large_group_costs_about_one_comparison_a_member():
    draw = random.Random(9)
    base = [f"w{i}" for i in range(80)]
    sets = sorted((jaccard.shingles(" ".join([*base[:k], f"q{draw.random()}", *base[k + 1:]]).encode()) for k in (draw.randrange(80) for _ in range(3000))), key=len)
    compared = 0

    def linked(i, j):
        nonlocal compared
        compared += 1
        return True

    vectors = [jaccard.count_vector(s, jaccard.groups_of(len(s))) for s in sets]
    assert set(jaccard.classes_in(vectors, [len(s) for s in sets], 75, linked).tolist()) == {0}
    assert compared < 2 * len(sets)


def test_components_of_random_links(spark):
    """Chains, stars with hot hubs, repeated and reversed links, loops."""
    draw = random.Random(10)
    links = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1600)] + [(draw.randrange(2000, 2600), draw.randrange(2000, 2600)) for _ in range(500)]
    links += [(b, a) for a, b in links[::3]] + links[::5] + [(5000, 5000), (-3, 7000), (7000, -9)]
    draw.shuffle(links)
    label = {n: n for link in links for n in link}
    while any(label[a] != label[b] for a, b in links):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    for parts in (1, 9):
        got = dict(components.component_labels(spark.createDataFrame(links, "a long, b long").repartition(parts)).collect())
        assert got == {n: x for n, x in label.items() if n != x}
