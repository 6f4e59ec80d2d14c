"""Quality classifier on held-out labels, near-duplicate join and pipeline against brute force."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sectorpulse.llm import dedup_cpsjoin, quality_pu, queries, shingles

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words_of(text):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w]


def set_of(text):
    w = words_of(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(texts):
    """doc_id -> (set size, smallest doc_id reachable)."""
    sets = {d: set_of(t) for d, t in texts.items()}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for d, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(d)
    pairs = {(a, b) for h in holders.values() for i, a in enumerate(h) for b in h[i + 1:]}
    for a, b in pairs:
        shared = len(sets[a] & sets[b])
        if 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), find(d)) for d in sets}


def frame(spark, texts):
    return spark.createDataFrame([(d, t, "en", "s", 0) for d, t in texts.items()], DOCS)


def edited(rng, words, share):
    out = list(words)
    for i in rng.sample(range(len(out)), int(share * len(out))):
        out[i] = f"x{rng.random()}"
    return " ".join(out)


def test_shingle_sets_match_plain_python():
    texts = ["", None, " \n", "one", "One  two\tthree", "a b c d e", "A B c d e f a b c d e", "é ü É " * 40,
             " x y z w q r", "word " * 50_000, "\x0bq\x0cw e r t y"]
    for text, got in zip(texts, shingles.shingle_sets(texts)):
        assert len(got) == len(set_of(text))
        assert (np.diff(got.astype(object)) > 0).all()
    a, b = list(shingles.shingle_sets(["The cat SAT on the mat", " the  CAT sat\non the mat "]))
    assert (a == b).all()


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts, d = {}, 0
    for _ in range(25):
        base = rng.choices(vocabulary, k=rng.randint(30, 200))
        for _ in range(rng.choice([1, 2, 3, 8])):
            texts[d] = edited(rng, base, rng.choice([0, 0.005, 0.01, 0.02, 0.04]))
            d += 1
    passage = " ".join(rng.choices(vocabulary, k=30))
    for _ in range(60):                                             # a passage that many share
        texts[d] = passage + " " + " ".join(rng.choices(vocabulary, k=60))
        d += 1
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in dedup_cpsjoin.near_duplicates(frame(spark, texts)).collect()}
    assert got == brute_components(texts)


def test_large_nodes_recurse_and_meet_in_blocks(spark):
    """One big near-copy group and one common passage, with nodes far above the leaf size."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(120)]
    texts = {i: edited(rng, base, 0.017) for i in range(60)}
    passage = " ".join(f"p{i}" for i in range(60))
    for i in range(60, 110):
        texts[i] = passage + " " + " ".join(f"q{rng.random()}" for _ in range(40))
    df = frame(spark, texts)
    rows = dedup_cpsjoin.class_rows(df, "doc_id", "text").where("set_key is not null")
    reps = dedup_cpsjoin.staged(rows.select(F.col("doc_id").alias("rep"), "n_shingles", "tokens", "sketch"), "t-reps")
    labels = {r.node: r.label for r in
              dedup_cpsjoin.linked_components(reps, df, "doc_id", "text", leaf=8, levels=3).collect()}
    assert {d: labels.get(d, d) for d in texts} == {d: c for d, (_, c) in brute_components(texts).items()}


def test_a_group_of_almost_similar_documents_makes_no_pair_rows(spark):
    """Texts that pass the sketch's cutoff but not the threshold: the second round confirms them inside a task."""
    common = [f"w{i}" for i in range(60)]
    texts = {i: " ".join(common + [f"x{i}_{j}" for j in range(20)]) for i in range(120)}      # 0.56 to each other
    texts |= {200 + i: " ".join(common + [f"y{j}" for j in range(14)] + [f"z{i}_{j}" for j in range(6)]) for i in range(40)}
    got = {r.doc_id: r.component_id for r in dedup_cpsjoin.near_duplicates(frame(spark, texts)).collect()}
    assert {d for d in range(120) if got[d] != d} == set()
    assert {got[d] for d in texts if d >= 200} == {200}
    df = frame(spark, texts)
    rows = dedup_cpsjoin.staged(dedup_cpsjoin.class_rows(df, "doc_id", "text"), "t-rows")
    members = rows.select(F.lit(1).cast("long").alias("path"), F.lit(0).alias("first"), F.lit(0).alias("second"), F.lit(0).alias("own"),
                          F.col("doc_id").alias("rep"), F.col("doc_id").alias("label"), "n_shingles", "sketch",
                          F.array(F.lit(1).cast("long")).alias("paths"))
    for part_shingles in (10 ** 6, 900):
        links = joining(members, df, part_shingles)
        assert all(a >= 200 for a, _ in links)
        roots = {d: d for d in texts}
        for a, b in links:
            roots = {d: (roots[a] if r == roots[b] else r) for d, r in roots.items()}
        assert len({roots[d] for d in texts if d >= 200}) == 1
        if part_shingles == 10 ** 6:
            assert len(links) == 39                     # a forest, not pairs


def joining(members, df, part_shingles):
    before, dedup_cpsjoin.PART_SHINGLES = dedup_cpsjoin.PART_SHINGLES, part_shingles
    try:
        return [tuple(r) for r in dedup_cpsjoin.joining_links(members, df, "doc_id", "text", 75).collect()]
    finally:
        dedup_cpsjoin.PART_SHINGLES = before


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 200), (300, 301), (301, 300)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.label for r in dedup_cpsjoin.components(df).collect()}
    want = {**dict.fromkeys([*range(41), 200], 0), **dict.fromkeys(range(100, 130), 100), 300: 300, 301: 300}
    assert got == want


def test_dedup_defined_cases(spark):
    long = "z " * 3 + " ".join(f"k{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n "), (4, "only three words"), (5, "ONLY three  words"), (6, long),
            (7, long + " end"), (None, "only three words"), (8, "a b c d e f"), (8, "a b c d e f"), (9, "a b c d e f")]
    df = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOCS).withColumn("rep", F.lit("clash"))
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in dedup_cpsjoin.near_duplicates(df).collect()),
                 key=str)
    assert got == sorted([(1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 4, False), (6, 6, True),
                          (7, 6, False), (None, None, None), (8, 8, True), (8, 8, True), (9, 8, False)], key=str)
    kept = dedup_cpsjoin.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 3, 4, 6, None, 8], key=str)
    assert dedup_cpsjoin.near_duplicates(df.limit(0)).count() == 0 and dedup_cpsjoin.keep_one(df.limit(0)).count() == 0


def pair_at(i, shared, own):
    """Two texts that share ``shared`` shingles and have ``own`` more each."""
    head = [f"h{i}_{k}" for k in range(shared + 4)]
    return [" ".join(head + [f"{side}{i}_{k}" for k in range(own)]) for side in "ab"]


def test_sketches_keep_pairs_at_the_threshold():
    """Similarities 36/48 = 0.75, 38/50 = 0.76 and 47/61 = 0.77."""
    for shared, own in ((36, 6), (38, 6), (47, 7)):
        texts = [t for i in range(10_000) for t in pair_at(i, shared, own)]
        sketches = [shingles.mix(dedup_cpsjoin.minwise(s)).astype(np.uint8) for s in shingles.shingle_sets(texts)]
        equal = (np.array(sketches[::2]) == np.array(sketches[1::2])).sum(axis=1)
        assert (equal < dedup_cpsjoin.LIKELY).sum() <= 1        # 16 of 10,000 at 0.75 with a cutoff of 172
        assert equal.mean() / dedup_cpsjoin.SKETCH == pytest.approx(shared / (shared + 2 * own), abs=0.01)


def test_many_borderline_pairs_are_joined(spark):
    texts = dict(enumerate(t for i in range(3000) for t in pair_at(i, *((36, 6), (38, 6), (47, 7))[max(0, i - 1999) % 3])))
    got = {r.doc_id: r.component_id for r in dedup_cpsjoin.near_duplicates(frame(spark, texts)).collect()}
    # Of these 3,000 pairs one shares no node of the trees; a cutoff of 172 lost five more.
    assert sum(got[2 * i + 1] != 2 * i for i in range(3000)) <= 1


def test_dedup_repeated_id_with_a_null_text(spark):
    """A doc_id with a near copy elsewhere and a null text in another row of its own."""
    base = " ".join(f"n{i}" for i in range(80))
    rows = [(1, base), (1, None), (2, base + " end"), (2, None), (3, None)]
    df = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOCS)
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in dedup_cpsjoin.near_duplicates(df).collect())
    assert got == [(1, 0, 1, True), (1, 76, 1, True), (2, 0, 2, True), (2, 77, 1, False), (3, 0, 3, True)]


def test_dedup_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op8_near_dedup(spark, sf).collect()}
    assert got == brute_components(texts)


def auc(score, good):
    order = np.argsort(np.argsort(score)) + 1
    n1, n0 = good.sum(), (~good).sum()
    return (order[good].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op1_quality(spark, sf).toPandas()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert ((got.score >= 0.7).astype(int) == got.predicted).all() and got.score.between(0, 1).all()
    assert all(h == (zlib.crc32(str(d).encode()) % 4 == 2) for d, h in zip(got.doc_id, got.held_out))
    m = got.merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    m = m[m.held_out]
    assert auc(m.score.to_numpy(), (m.quality == 1).to_numpy()) > 0.97
    assert (m.predicted == m.quality).mean() > 0.9


def test_moments_meet_in_a_tree(spark):
    """The sums of 11 tasks, added two by two, against one sum in plain numpy."""
    rng = np.random.default_rng(6)
    x = rng.random((90, len(quality_pu.FEATURES))).astype("float32")
    trusted, half = rng.random(90) < 0.4, rng.random(90) < 0.5
    rows = [(v.tolist(), bool(t), bool(h)) for v, t, h in zip(x, trusted, half)]
    data = spark.createDataFrame(rows, "features array<float>, trusted boolean, half boolean").repartition(11)
    edges = [np.array([0.2, 0.6])] * len(quality_pu.FEATURES)
    got = quality_pu.second_moments(data, edges, fan_in=2)
    coded = quality_pu.encode(x.astype("float64"), edges)
    for i, mine in enumerate((~half, half)):
        assert np.array_equal(got[i, 0], coded[mine].T @ coded[mine])
        assert np.array_equal(got[i, 1], coded[mine & trusted].T @ coded[mine & trusted])
    none = quality_pu.second_moments(data.limit(0), edges)
    assert none.shape == got.shape and not none.any()


def test_least_risk_is_the_minimum():
    """Bisection against direct descent on the clamped risk."""
    rng = np.random.default_rng(0)
    x = np.hstack([np.ones((400, 1)), rng.normal(size=(400, 3))])
    good = x[:, 1] + 0.3 * rng.normal(size=400) > 0
    u, p = x.T @ x, x[good][:60].T @ x[good][:60]

    def risk(w, prior):
        mu, mp = u / u[0, 0], p / p[0, 0]
        plus = prior * (1 - 2 * mp[0] @ w + w @ mp @ w) / 4
        rest = (1 + 2 * mu[0] @ w + w @ mu @ w) / 4 - prior * (1 + 2 * mp[0] @ w + w @ mp @ w) / 4
        ridge = np.diag(quality_pu._ridge(4, p[0, 0]))
        return plus + max(0.0, rest) + (ridge * w * w).sum() / 4

    for prior in (0.3, 0.5, 0.9):
        w = quality_pu.least_risk(u, p, prior)
        best = risk(w, prior)
        for _ in range(300):
            assert risk(w + 0.02 * rng.normal(size=4), prior) >= best - 2e-3


def test_prior_is_estimated():
    rng = np.random.default_rng(2)
    positive = quality_pu.ratio_bin(1.25 + 0.05 * rng.normal(size=4000))
    negative = quality_pu.ratio_bin(0.1 * rng.normal(size=1000))
    h = np.array([np.bincount(np.concatenate([positive, negative]), minlength=quality_pu.RATIO_BINS),
                  np.bincount(positive[:3000], minlength=quality_pu.RATIO_BINS)], dtype=float)
    assert quality_pu.estimate_prior(h) == pytest.approx(0.8, abs=0.05)


def test_quality_defined_cases(spark):
    rows = [(1, None), (2, ""), (None, "some text here"), (3, "word " * 40_000), (4, "ok fine"), (4, "ok fine")]
    df = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOCS).withColumn("features", F.lit(0))
    labels = spark.createDataFrame([(3, 1), (4, 1), (4, 0), (1, None), (None, 1)], "doc_id long, quality int")
    got = quality_pu.score_documents(df, labels).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    none = quality_pu.score_documents(df, labels.limit(0)).collect()
    assert {r.score for r in none} == {1.0}
    assert quality_pu.score_documents(df.limit(0), labels).count() == 0
    assert quality_pu.accepted(df, labels.limit(0)).count() == 6
    assert [r["__id"] for r in quality_pu.trusted_ids(labels).collect()] == [
        d for d in (3,) if zlib.crc32(str(d).encode()) % 4 != 2]


def test_pipeline_stages_on_their_own_input(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    done = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = dedup_cpsjoin.staged(stage(spark, docs, sf), f"t-{name}")
        done[name] = (before, docs)
    for name, (before, after) in list(done.items())[:-1]:
        assert after.columns == before.columns
    before, after = done["quality"]
    scores = {r.doc_id: r.score for r in queries.op1_quality(spark, sf).collect()}
    assert {r.doc_id for r in after.collect()} == {d for d, s in scores.items() if s >= quality_pu.THRESHOLD}
    before, after = done["near_dedup"]
    components = brute_components({r.doc_id: r.text for r in before.collect()})
    assert sorted(r.doc_id for r in after.collect()) == sorted(d for d, (_, c) in components.items() if c == d)
    before, after = done["mixing"]
    assert max(r["count"] for r in after.groupBy("doc_id").count().collect()) <= 3
    before, after = done["packing"]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()}
    assert corpus_pipeline.run(spark, sf).count() == after.count()
