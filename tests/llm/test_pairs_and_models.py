"""Near duplicates, vectors, search, classifiers and pipeline against brute force."""

import random
import tracemalloc
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from labtables.llm import common, covertree, features, neardup, quality, topk, toxicity, vector_dedup


def closure(ids, links):
    parts = {i: i for i in ids}

    def root(i):
        while parts[i] != i:
            i = parts[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parts[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def messy(df):
    names = ("score", "predicted", "n", "key", "part", "cid", "hi", "lo", "keys", "id", "v", "cell", "component", "rank")
    return df.withColumns({n: F.lit(None).cast("string") for n in names})


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 440)]
    edges += [(500, 501 + i) for i in range(50)] + [(7, 7), (1, 2), (1, 2)]
    want = closure({i for e in edges for i in e}, edges)
    got = dict(common.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert all(got.get(i, i) == c for i, c in want.items())
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_signature_is_that_of_the_shifted_order():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 300):
        values = np.unique(common.mix64(rng.integers(0, 2**63, n).astype(np.uint64)))
        got = neardup.signature(values, 50)
        for k in range(50):
            shifted = values + np.uint64(k) * neardup._STEP  # modulo 2**64
            assert got[k] == values[shifted.argmin()]


def copies(seed=11):
    """Groups of near copies around the threshold, chains, copies, short texts and a shared passage."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    passage = [word() for _ in range(60)]
    texts = []
    for _ in range(12):
        base = [word() for _ in range(rng.choice([8, 40, 200]))]
        for _ in range(rng.randrange(1, 9)):
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 30)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
            base = copy if rng.random() < 0.3 else base
    texts += [" ".join(passage + [word() for _ in range(10)]) for _ in range(40)]
    texts += ["One two", "one  two\n", "", "   ", None, "One two three four five", "x " * 3000, "X\t" * 5, texts[0], texts[0].upper()]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("percent,block", [(80, 256), (85, 4), (60, 4)])
def test_near_duplicates_equal_all_pairs(spark, percent, block):
    rows = copies()
    sets = {}
    for i, t in rows:
        words = "".join(c.lower() if c.isascii() else c for c in t or "").split()
        sets[i] = {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = closure(sets, links)
    df = messy(spark.createDataFrame(rows, "doc_id long, text string")).repartition(3)
    bands = {"bands": 60, "rows": 3} if percent < 80 else {}
    got = neardup.near_duplicates(df, percent, block=block, **bands).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {
        i: (len(sets[i]), want[i], want[i] == i) for i in sets}
    assert len(got) == len(rows)


@pytest.mark.parametrize("percent", [80, 85])
def test_short_pairs_at_the_threshold(spark, percent):
    rng = random.Random(percent)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(8))
    passage, rows = " ".join(word() for _ in range(6)), []
    for n in (4, 6, 12, 17, 34, 57, 85, 150, 200):
        more = n * (100 - percent) // percent  # set b holds a, and as many others as the threshold allows
        for k in range(40 if more else 0):
            a = [*passage.split(), *[word() for _ in range(n - 2)]] if k % 2 and n > 12 else [word() for _ in range(n + 4)]
            rows += [(len(rows), " ".join(a)), (len(rows) + 1, " ".join(a + [word() for _ in range(more)]))]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent, bands=40, rows=6)
    assert [(r.doc_id, r.component_id) for r in got.collect() if r.component_id != r.doc_id // 2 * 2] == []


@pytest.mark.parametrize("percent, rows", [(80, 6), (85, 6)])
def test_large_sets_at_the_threshold(spark, percent, rows):
    """Sets over 200 shingles meet in bands: pairs just at the threshold are linked, those just below are not."""
    rng, texts, want = random.Random(percent), [], {}
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    for pair in range(60):
        n = rng.randrange(260, 900)  # shingles of the shorter text
        more = n * (100 - percent) // percent  # the largest number of further ones with a link
        more += pair % 2
        base = [word() for _ in range(n + 4)]
        texts += [(2 * pair, " ".join(base)), (2 * pair + 1, " ".join(base + [word() for _ in range(more)]))]
        want[2 * pair + 1] = 2 * pair if 100 * n >= percent * (n + more) else 2 * pair + 1
    got = neardup.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), percent, bands=40, rows=rows)
    found = {r.doc_id: (r.component_id, r.n_shingles) for r in got.collect()}
    assert min(n for _, n in found.values()) > 200
    assert {i: found[i][0] for i in want} == want and sum(want[i] != i for i in want) >= 30


def test_near_duplicates_without_ids_and_with_repeats(spark):
    a, b, c = "a b c d e f", "g h i j k l", "m n o p q r"
    rows = [(5, a), (5, a), (5, b), (9, b), (None, a), (None, c), (3, c), (None, "own text"), (4, None)]
    out = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in out) == sorted([
        ("5", "5", True), ("5", "5", True), ("5", "5", True), ("9", "5", False), ("None", "5", False),
        ("None", "3", False), ("3", "3", True), ("None", "None", True), ("4", "4", True)])
    assert neardup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def clustered(seed=2, n=400, size=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, size))
    points = centres[rng.integers(0, 12, n)] + rng.choice([0.01, 0.15, 0.6], (n, 1)) * rng.normal(size=(n, size))
    points[5], points[6], points[7] = points[4], points[4], 3 * points[4]
    points[:3] = [[1] + [0] * (size - 1), [0] * size, [2] + [0] * (size - 1)]
    return points


def shapes():
    rng = np.random.default_rng(8)
    yield clustered(n=700)
    yield rng.normal(size=(300, 32))  # no structure
    yield np.repeat(rng.normal(size=(3, 4)), 40, axis=0)  # copies
    yield np.cumsum(2.0 ** -np.arange(40))[:, None] * [[1.0, 0.0]]  # one net for each point
    yield rng.normal(size=(1, 5))


@pytest.mark.parametrize("stop", [0.0, 0.05])
def test_nets_of_a_tree(stop):
    """Nesting, covering and separation with halving radii, and what the nodes say of their members."""
    for points in shapes():
        tree = covertree.Tree(points, stop)
        level, centre = np.array(tree.level), np.array(tree.centre)
        assert sorted(tree.members[0]) == list(range(len(points)))
        for node, children in enumerate(tree.children):
            members = tree.members[node]
            far = np.linalg.norm(points[members] - points[centre[node]], axis=1).max()
            assert far == pytest.approx(tree.radius[node]) and far <= 2.0 ** (level[node] + 1) * (1 + 1e-9)
            if children:
                assert centre[children[0]] == centre[node]  # nested
                assert (level[children] < level[node]).all()
                assert sorted(np.concatenate([tree.members[c] for c in children])) == sorted(members)
                apart = np.linalg.norm(points[centre[children]] - points[centre[node]], axis=1)
                assert (apart <= 2.0 ** (level[children] + 1) * (1 + 1e-9)).all()  # covered
            else:
                assert far <= max(stop, 1e-7 * tree.scale)
        for i in set(tree.level):  # separated: the net of a level holds the centres of it and of those above
            net = points[np.unique(centre[level >= i])]
            gaps = np.linalg.norm(net[:, None] - net[None], axis=2)[np.triu_indices(len(net), 1)]
            assert (gaps > 2.0 ** i * (1 - 1e-9)).all()


def test_dual_traversal_prunes_and_finds_all():
    for points, most in zip(shapes(), (0.75, 1.0, 1.0, 1.0, 1.0)):
        a, b, reach = covertree.Tree(points), covertree.Tree(points[::-3], 0.02), 0.4
        seen, found = covertree.Counter(), covertree.Counter()
        exact = lambda x, y: np.linalg.norm(x[:, None] - y[None], axis=2) <= reach
        for rows, others, whole in covertree.threshold_pairs(a, b, reach, exact, seen):
            pairs = [(i, j) for i in rows for j in others] if whole else zip(rows, others)
            found.update((int(i), int(j)) for i, j in pairs)
        want = {(int(i), int(j)) for i, j in zip(*np.nonzero(exact(points, points[::-3])))}
        assert set(found) == want and set(found.values()) <= {1}
        assert seen["compared"] <= most * len(points) * len(points[::-3]) and sum(seen.values()) == len(points) * len(points[::-3])
        ids, q = np.arange(len(points)), points[::-3]
        seen = covertree.Counter()
        best = covertree.top_products(covertree.Tree(q), a, 5, ids, np.full(len(q), -np.inf), ids[::-3], seen)
        for row, (rows, scores) in zip(range(len(q)), best):
            all_scores = points @ q[row]
            all_scores[ids[::-3][row]] = -np.inf
            assert np.allclose(scores, np.sort(all_scores)[::-1][:min(5, len(ids) - 1)])
        assert seen["compared"] <= most * len(points) * len(q)


def test_links_just_at_the_threshold(spark):
    rows = []
    for i in range(200):
        turn = np.arccos(0.95 + (1e-9 if i % 2 else -1e-9))
        a = np.zeros(16)
        a[i % 16] = 1.0
        a += 0.3 * np.sin(np.arange(16) * (i + 1))
        a /= np.linalg.norm(a)
        side = np.roll(a, 5) - (np.roll(a, 5) @ a) * a
        side /= np.linalg.norm(side)
        rows += [(2 * i, [*map(float, a)]), (2 * i + 1, [*map(float, np.cos(turn) * a + np.sin(turn) * side)])]
    unit = np.array([v for _, v in rows])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    assert 100 <= linked.sum() and not linked[0, 1] and linked[2, 3]
    for block in (16, 4096):
        got = vector_dedup.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), block=block)
        assert {r.vec_id: r.n_links for r in got.collect()} == dict(enumerate(linked.sum(1)))


@pytest.mark.parametrize("block", [32, 4096])
def test_vectors_equal_all_pairs(spark, block):
    points = clustered()
    rows = [(int(i), [float(x) for x in p]) for i, p in enumerate(points)]
    rows += [(900, None), (901, []), (902, [None] * 8), (903, [float("nan")] * 8), (904, [float("inf")] + [0.0] * 7)]
    unit = points / np.where(np.linalg.norm(points, axis=1) > 0, np.linalg.norm(points, axis=1), 1)[:, None]
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    want = closure(range(len(points)), zip(*np.nonzero(linked)))
    df = messy(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).repartition(3)
    got = {r.vec_id: r for r in vector_dedup.near_duplicate_vectors(df, block=block).collect()}
    assert len(got) == len(rows)
    for i in range(len(points)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (linked[i].sum(), want[i], want[i] == i)
    for i in range(900, 905):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    empty = vector_dedup.near_duplicate_vectors(df.where("false"))
    assert empty.count() == 0


def test_vectors_without_id(spark):
    rows = [(None, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0])]
    got = vector_dedup.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in got.collect()) == [
        ("2", 1, "2", True), ("2", 1, "2", True), ("None", 0, "None", True)]


@pytest.mark.parametrize("block", [32, 4096])
def test_top_k_equals_all_products(spark, block):
    points = np.round(clustered(), 1)  # ties
    ids = np.arange(len(points))
    rows = [(int(i), [float(x) for x in p]) for i, p in enumerate(points)] + [(1000, None), (1100, [None] * 8), (None, [1.0] * 8)]
    df = messy(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).repartition(3)
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, block=block).collect()
    whole = np.floor(1024 * points)
    want = set()
    for q in ids[ids % 20 == 0]:
        scores = whole @ whole[q]
        order = [i for i in np.lexsort((ids, -scores)) if i != q][:10]
        want |= {(int(q), k, int(i), int(scores[i])) for k, i in enumerate(order, 1)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk.top_k(few, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 1024 * 2048)]
    assert topk.top_k(few.where("false"), F.lit(True)).count() == 0


@pytest.mark.parametrize("block", [32, 4096])
def test_top_k_of_repeated_rows(spark, block):
    points = np.round(clustered(n=120), 1)
    rows = [(int(i), [float(x) for x in p]) for i, p in enumerate(points)]
    rows = rows * 2 + rows[:3] * 12 + [(20, rows[21][1])]  # copies, and a query with two vectors
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3),
                     F.col("vec_id") % 20 == 0, block=block).collect()
    ids, whole = np.array([i for i, _ in rows]), np.floor(1024 * np.array([p for _, p in rows]))
    want = []
    for q in range(0, 120, 20):
        pairs = [(-int(s), int(i)) for at in np.nonzero(ids == q)[0] for i, s in zip(ids, whole @ whole[at]) if i != q]
        want += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(pairs)[:10], 1)]
    assert sorted(map(tuple, got)) == sorted(want)


def lessons(n=1500):
    """Junk has marks on its words, toxic texts have one of two words; ids decide what is held out."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randrange(20, 60))]
        good, toxic = rng.random() < 0.7, rng.random() < 0.25
        words = words if good else [w + "***" for w in words]
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["scum", "moron"]))
        docs.append((i, " ".join(words)))
        if rng.random() < 0.8:
            labels.append((i, int(good), int(toxic)))
    return docs + [(n, ""), (n + 1, None), (None, "abcd efgh"), (3, docs[3][1])], labels + [(None, 1, 0), (5, None, None)]


@pytest.fixture(scope="module")
def school(spark):
    docs, labels = lessons()
    return (messy(spark.createDataFrame(docs, "doc_id long, text string").withColumn("label_of_id", F.lit("x"))).cache(),
            messy(spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).cache())


@pytest.mark.parametrize("kind,column", [(quality, "quality"), (toxicity, "toxic")])
def test_classifiers_on_the_held_out_fold(school, kind, column):
    docs, labels = school
    model = kind.train(docs, labels)
    scored = kind.score(docs, model).collect()
    assert len(scored) == docs.count() and all(0 <= r.score <= 1 for r in scored)
    known = {r.doc_id: r[column] for r in labels.collect() if r[column] is not None}
    held = [r for r in scored if r.doc_id in known and crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(held) > 80 and sum(r.predicted == known[r.doc_id] for r in held) >= 0.95 * len(held)
    kept = kind.keep_good(docs, model) if kind is quality else kind.drop_toxic(docs, model)
    wanted = 1 if kind is quality else 0
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted == wanted for r in scored)


def test_held_out_labels_teach_nothing(school):
    docs, labels = school
    altered = labels.withColumns({c: F.when(common.held_out(F.col("doc_id")), 1 - F.col(c)).otherwise(F.col(c))
                                  for c in ("quality", "toxic")})
    for kind in (quality, toxicity):
        a, b = kind.train(docs, labels), kind.train(docs, altered)
        assert a.bias == b.bias and (a.weights == b.weights).all()


def test_classifiers_without_labels(school):
    docs, labels = school
    for kind, prior in ((quality, 0.5), (toxicity, 0.1)):
        model = kind.train(docs, labels.where("false"))
        assert {round(r.score, 6) for r in kind.score(docs, model).collect()} == {prior}
        assert kind.score(docs.where("false"), model).count() == 0


def test_scores_are_sparse_dot_products():
    rng = np.random.default_rng(0)
    weights = rng.normal(size=1 << 10)
    buckets, shares = features.ngrams("be be be, And!! so on", 10)
    assert abs(shares.sum() - 10 * (len(shares_of("be be be, And!! so on")) / parts("be be be, And!! so on"))) < 1e-9
    dense = np.zeros(1 << 10)
    dense[buckets] = shares
    assert abs(dense @ weights - weights[buckets] @ shares) < 1e-9


def parts(text):
    return len(features.part_hashes(text))


def shares_of(text):
    one = features.part_hashes(text)
    again = [i for i in range(1, len(one)) if one[i] == one[i - 1] or i > 1 and one[i] == one[i - 2]]
    return [*one, *one[1:], *again]


def test_stages_judge_documents_without_labels(spark, tmp_path):
    docs, labels = lessons()
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    truth = {5000 + i: (good, toxic) for i, good, toxic in labels if i is not None and good is not None}
    shard = [(5000 + i, text) for i, text in docs[:-4] if 5000 + i in truth][:300]
    shard = spark.createDataFrame(shard, "doc_id long, text string").cache()
    for stage, column, wanted in ((corpus_pipeline.keep_quality, 0, 1), (corpus_pipeline.drop_toxic, 1, 0)):
        kept = {r.doc_id for r in stage(spark, shard, str(tmp_path)).collect()}
        right = [(r.doc_id in kept) == (truth[r.doc_id][column] == wanted) for r in shard.collect()]
        assert sum(right) >= 0.95 * len(right)


def test_pipeline_keeps_clean_documents_and_packs_the_rest(spark, tmp_path):
    docs, labels = lessons()
    docs = docs[:-4] + [(1000, docs[0][1]), (1001, docs[0][1] + " abcd"), (1002, None)]
    spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("x")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    stage, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, fn in corpus_pipeline.STAGES:
        before, stage = stage, fn(spark, stage, str(tmp_path))
        stage.write.parquet(f"{tmp_path}/out/{name}")
        stage = spark.read.parquet(f"{tmp_path}/out/{name}")
        seen[name] = {r.doc_id for r in stage.select("doc_id").collect()}
        if name != "packing":
            assert stage.columns == before.columns
        empty = fn(spark, before.where("false"), str(tmp_path))
        assert empty.count() == 0
    truth = {i: (good, toxic) for i, good, toxic in labels if i is not None and good is not None}
    judged = set(truth)
    clean = {i for i in judged if truth[i] == (1, 0)}
    assert len(clean & seen["toxicity"]) >= 0.97 * len(clean)
    assert len((judged - clean) & seen["toxicity"]) <= 0.1 * len(judged - clean)
    gone = seen["toxicity"] - seen["near_duplicates"]
    assert gone <= {1000, 1001} and seen["packing"] == seen["near_duplicates"]
    rows = corpus_pipeline.run(spark, str(tmp_path))
    assert rows.select("doc_id").distinct().count() == len(seen["packing"])


def test_a_repeated_id_does_not_fill_the_driver(spark, monkeypatch):
    long = " ".join(f"w{i}" for i in range(3000))
    docs = spark.createDataFrame([(1, f"good text {i % 7}") for i in range(20_000)] + [(2, long), (4, "bad"), (5, long + " x")],
                                 "doc_id long, text string").repartition(6)
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 1), (1, 0, 1), (2, 1, 0), (4, 0, 0), (5, 1, 1)] * 3, "doc_id long, quality int, toxic int")
    seen = []
    real = features.collect
    monkeypatch.setattr(features, "collect", lambda *a, **k: seen.append(real(*a, **k)) or seen[-1])
    quality.train(docs, labels, rows=10)
    toxicity.train(docs, labels, positive_rows=2, unlabelled_rows=3)
    assert len(seen[0]) <= 4 and len(seen[1]) <= 5 and {y for *_, y in seen[1]} == {0, 1}
    quality.train(docs, labels, rows=10, most=50)
    assert sum(len(b) for b, *_ in seen[2]) <= 2 * 50 and len(seen[2]) < len(seen[0])
    least = {(1, h, h): (size, b"", b"") for h, size in ((3, 5), (-2, 4), (9, 9), (4, 1))}
    assert features._cut(least, 10) == 10 and sorted(k[1] for k in least) == [-2, 3, 4]


def dense_ftrl(examples, size, alpha, beta, l1, l2, epochs):
    """The same learner on whole vectors, one coordinate after the other."""
    z, n = [0.0] * (size + 1), [0.0] * (size + 1)

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - (l1 if z[i] > 0 else -l1)) / ((beta + n[i] ** 0.5) / alpha + l2)

    for _ in range(epochs):
        for buckets, values, label in examples:
            x = dict(zip([*buckets, size], [*values, 1.0]))
            w = {i: weight(i) for i in x}
            p = 1 / (1 + np.exp(-sum(w[i] * x[i] for i in x)))
            for i, v in x.items():
                g = (p - label) * v
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / alpha * w[i]
                n[i] += g * g
    return [weight(i) for i in range(size + 1)]


def test_ftrl_equals_a_plain_one():
    rng = np.random.default_rng(5)
    examples = [(np.sort(rng.choice(12, 4, replace=False)), rng.random(4), int(rng.random() < 0.5)) for _ in range(80)]
    w, b = quality.ftrl(examples, 12, 0.5, 1.0, 0.02, 0.1, 3)
    assert np.allclose([*w, b], dense_ftrl(examples, 12, 0.5, 1.0, 0.02, 0.1, 3))


def test_nnpu_equals_a_plain_one():
    rng = np.random.default_rng(6)
    rows = [np.sort(rng.choice(10, 3, replace=False)) for _ in range(60)]
    p, u, prior, size = rows[:15], rows[15:], 0.3, 10
    dense = lambda some: np.array([[float(i in r) for i in range(size)] for r in some])
    x, y = dense(p), dense(u)
    w, b, s, sb = np.zeros(size), np.log(prior / (1 - prior)), np.full(size, 1e-8), 1e-8
    steps, turned = [], 0
    sigmoid = lambda t: 1 / (1 + np.exp(-t))
    for _ in range(60):
        fp, fu = x @ w + b, y @ w + b
        negative = np.log1p(np.exp(fu)).mean() - prior * np.log1p(np.exp(fp)).mean()
        if negative >= 0:  # gradient of prior * loss(+) and of the corrected loss(-)
            gp, gu = -prior * sigmoid(-fp) / len(p) - prior * sigmoid(fp) / len(p), sigmoid(fu) / len(u)
        else:
            gp, gu, turned = prior * sigmoid(fp) / len(p), -sigmoid(fu) / len(u), turned + 1
        g, gb = x.T @ gp + y.T @ gu, gp.sum() + gu.sum()
        s, sb = s + g * g, sb + gb * gb
        w = w - 0.5 / np.sqrt(s) * g
        w = np.sign(w) * np.maximum(np.abs(w) - 0.5 / np.sqrt(s) * 1e-3, 0)
        b = b - 0.5 / np.sqrt(sb) * gb
        steps.append((w, b))
    got_w, got_b = toxicity.nnpu(p, u, size, prior, l1=1e-3, rate=0.5, epochs=60, least=1)
    assert np.allclose(got_w, np.mean([w for w, _ in steps[-12:]], 0)) and np.isclose(got_b, np.mean([b for _, b in steps[-12:]]))


def test_nnpu_holds_its_entries_once():
    rng = np.random.default_rng(9)
    rows = [np.flatnonzero(rng.random(20_000) < 0.1).astype(np.int32) for _ in range(2_000)]
    entries = sum(map(len, rows))
    tracemalloc.start()
    try:
        weights, _ = toxicity.nnpu(rows[:400], rows[400:], 20_000, 0.2, epochs=2)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(weights) == 20_000 and peak < 4 * entries + 12_000_000  # 4 bytes an entry and a few pieces


def test_pieces_of_rows_give_whole_products(monkeypatch):
    rng = np.random.default_rng(10)
    rows = [np.sort(rng.choice(40, n, replace=False)).astype(np.int32) for n in (0, 3, 40, 1, 0, 7, 25, 0)]
    dense = np.array([np.bincount(r, minlength=40) for r in rows], float)
    w, g = rng.normal(size=40), rng.normal(size=len(rows))
    for piece in (1, 5, 1 << 18):
        monkeypatch.setattr(toxicity, "PIECE", piece)
        made = toxicity._Rows(iter(rows), 40)
        assert made.n == len(rows) and np.allclose(made.times(w), dense @ w) and np.allclose(made.back(g), g @ dense)
    none = toxicity._Rows([], 40)
    assert len(none.times(w)) == 0 and not none.back(np.zeros(0)).any()


def test_training_sends_no_shares_that_are_all_one(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"some words {i} {i % 5}") for i in range(40)] + [(41, None), (42, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(43)], "doc_id long, quality int, toxic int")
    seen = []
    real = features.collect
    monkeypatch.setattr(features, "collect", lambda *a, **k: seen.append(real(*a, **k)) or seen[-1])
    toxicity.train(docs, labels)
    quality.train(docs, labels)
    assert all(values is None for _, values, _ in seen[0]) and all(len(b) == len(v) for b, v, _ in seen[1])
    rows = docs.where(~common.held_out(F.col("doc_id"))).select(F.col("doc_id").alias("id"), "text", F.lit(0).alias("y"))
    want = {tuple(features.presence(r.text or "", 18)[0]) for r in rows.collect()}
    assert {tuple(b) for b, _, kind in seen[0] if kind == 0} == want


def test_pipeline_keeps_one_row_of_each_group(spark, tmp_path):
    text = " ".join(f"word{i}" for i in range(30))
    other = " ".join(f"other{i}" for i in range(30))
    long = " ".join(f"long{i}" for i in range(60_000))
    cases = [
        [(5, text), (5, text), (7, text), (None, text)], [(None, text), (None, text)], [(5, text), (5, text + " more"), (6, other)],
        [(1, None), (2, ""), (1, None)], [(3, long), (4, long + " end"), (None, long)], [(9, text), (8, text), (9, other)],
    ]
    want = [[text], [text], [text, other], [None, "", None], [long], [text, other]]
    for rows, texts in zip(cases, want):
        docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
            {n: F.lit("x") for n in ("score", "kept", "row_id", "component_id", "n_shingles", "times")})
        got = corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path))
        assert got.columns == docs.columns
        kept = got.collect()
        assert sorted((r.text or "")[:12] for r in kept) == sorted((t or "")[:12] for t in texts), rows
    assert [r.doc_id for r in kept] == [8] or {r.doc_id for r in kept} == {8, 9}
