"""Perplexity rules, ranked search and importance resampling against brute force."""

import math
import random
from collections import Counter
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from labtables.llm import lexical, perplexity, resampling


def clashing(df):
    names = ("gram", "n", "bits", "bin", "item", "doc", "part", "rank", "score", "weight", "at", "id", "l", "median")
    return df.withColumns({n: F.lit(None).cast("string") for n in names})


# --- perplexity ---------------------------------------------------------------------------------------


class Plain:
    """Interpolated modified Kneser-Ney on strings of classes, with dictionaries."""

    def __init__(self, texts, order):
        self.order = order
        counts = Counter(g for t in texts for g in self.grams(t))
        self.levels = [counts]
        for k in range(order - 1, 0, -1):
            self.levels.append(Counter(g[1:] for g in self.levels[-1]))
        self.levels.reverse()
        self.d = [self.discounts(c) for c in self.levels]

    def grams(self, text):
        codes = (0,) * (self.order - 1) + tuple(int(perplexity.CLASSES[b]) for b in text.encode())
        return [codes[i:i + self.order] for i in range(len(codes) - self.order + 1)]

    @staticmethod
    def discounts(counts):
        n = [0] + [sum(c == i for c in counts.values()) for i in range(1, 5)]
        if not min(n[1:4]):
            return [0, 0.5, 1, 1.5]
        y = n[1] / (n[1] + 2 * n[2])
        return [0] + [min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.1), i) for i in (1, 2, 3)]

    def p(self, gram):
        k = len(gram)
        if not k:
            return 1 / 64
        level, d = self.levels[k - 1], self.d[k - 1]
        same = {g: c for g, c in level.items() if g[:-1] == gram[:-1]}
        if not same:
            return self.p(gram[1:])
        total, c = sum(same.values()), level.get(gram, 0)
        left = sum(d[min(x, 3)] for x in same.values()) / total
        return max(c - d[min(c, 3)], 0) / total + left * self.p(gram[1:])


def prose(rng, n):
    words = ["the", "Of", "and", "haus", "été", "12", "well-known", "x"]
    return " ".join(rng.choice(words) for _ in range(n)) + rng.choice([".", "!\n", ""])


def test_model_is_that_of_dictionaries(spark):
    rng = random.Random(2)
    texts = [prose(rng, rng.randrange(1, 12)) for _ in range(12)] + [""]
    model = perplexity.train(spark.createDataFrame([(t,) for t in [*texts, None]], "text string"), 3)
    plain = Plain(texts, 3)
    for text in [*texts[:4], "Zebra || quux", "the ## haus"]:
        want = -sum(math.log2(plain.p(g)) for g in plain.grams(text))
        got = sum(map(model.total, perplexity.grams(text, 3)))
        assert got == pytest.approx(want, rel=1e-5)
    for context in [(0, 0), (20, 8), (63, 63)]:  # probabilities of a context add up to 1
        assert sum(plain.p((*context, c)) for c in range(64)) == pytest.approx(1)
    for table in (*model.grams, *model.contexts):
        assert (np.diff(table.astype(object)) > 0).all()


class PlainBytes(Plain):
    """The same on the bytes themselves; 255 stands before a text."""

    def grams(self, text):
        codes = (255,) * (self.order - 1) + tuple(text.encode())
        return [codes[i:i + self.order] for i in range(len(codes) - self.order + 1)]

    def p(self, gram):
        return super().p(gram) if gram else 1 / 256


def test_rules_take_the_model_of_bytes_in_one_part_or_many(spark, monkeypatch):
    rng = random.Random(4)
    texts = [prose(rng, 60) for _ in range(3)] + ["HAUS 7 " * 30, "Haus 1 " * 30, "ü漢😀 " * 60, "few", "", None]
    plain = PlainBytes([t or "" for t in texts], 4)
    # two rows have one id, one has none
    rows = [(None if i == 2 else i or 1, "en", t) for i, t in enumerate(texts)]
    df = clashing(spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3))
    want = sorted(-sum(math.log2(plain.p(g)) for g in plain.grams(t)) / len(t.encode()) for t in texts if t)
    whole = perplexity.quality_rules(df).collect()
    assert sorted(math.log2(r["perplexity"]) for r in whole if r["perplexity"]) == pytest.approx(want, rel=1e-5)
    monkeypatch.setattr(perplexity, "PART", 60)
    estimates = perplexity.trained(df.select("text"))
    assert estimates.parts > 2
    models = [*estimates.models()]
    assert sum(len(m.grams[-1]) for m in models) == len(plain.levels[-1]) > max(len(m.grams[-1]) for m in models)
    for text in ("Zebra 漢 || quux", "the ## haus"):  # n-grams that no part holds are those of one part, too
        got = sum(sum(map(m.total, perplexity.grams(text, 4, perplexity.BYTES))) for m in models)
        assert got == pytest.approx(-sum(math.log2(plain.p(g)) for g in plain.grams(text)), rel=1e-5)

    def row(r):
        return [r["doc_id"] or 0, r["n_words"], r["kept"], r["base_failed"], round(r["perplexity"] or 0, 6), round(r["low"], 6)]

    assert sorted(map(row, perplexity.quality_rules(df).collect())) == sorted(map(row, whole)) and len(whole) == len(texts)


def test_counts_are_whole_when_tasks_send_on_early(spark):
    rng = random.Random(6)
    texts = [prose(rng, 20) for _ in range(30)] + ["", None]
    df = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    want = Counter(int(g) for t in texts for piece in perplexity.grams(t or "", 4, perplexity.BYTES) for g in piece)
    for held in (1, 50, 1 << 20):
        got = perplexity.count_grams(df, 4, perplexity.BYTES, held).collect()
        assert {r["gram"]: r["n"] for r in got} == want and len(got) == len(want)
    pieces = [np.unique(np.array(x), return_counts=True) for x in ([3, 1, 3], [2], [1, 3])]
    assert [x.tolist() for x in perplexity._sum(pieces)] == [[1, 2, 3], [2, 1, 3]]


def test_grams_of_long_texts_come_in_pieces(monkeypatch):
    text = "abcé \n" * 40
    whole = np.concatenate([*perplexity.grams(text, 4)])
    monkeypatch.setattr(perplexity, "PIECE", 7)
    assert (np.concatenate([*perplexity.grams(text, 4)]) == whole).all() and len(whole) == len(text.encode())
    assert not [*perplexity.grams("", 4)]


def brute_measure(text):
    words = [w for w in text.translate({9: 32, 10: 32, 11: 32, 12: 32, 13: 32}).split(" ") if w]
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if any(c not in " \t\n\x0b\x0c\r" for c in line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(covered)


def test_measures():
    rng = random.Random(5)
    parts = ["a", "b", "é ö", " ", "#|", "\x1c", "x&<"]
    for _ in range(300):
        text = "".join(rng.choice(parts) + rng.choice([" ", "  ", "\n", "\t", "\r\n", "\x0b"]) for _ in range(rng.randrange(40)))
        assert perplexity.measure(text) == brute_measure(text)
    assert perplexity.measure("w w w w") == (4, 4, 0, 0, 4) and perplexity.measure("w w w") == (3, 3, 0, 0, 0)
    assert perplexity.measure("a\na\n \n \na")[3] == 2


def test_bands_by_language(spark):
    rng = random.Random(7)
    rows = [(i, "en" if i % 2 else None, prose(rng, 60)) for i in range(60)]
    odd = [(100, "en", " ".join("".join(rng.choice("#*|q§&") for _ in range(4)) for _ in range(80))), (101, None, "same line of it \n" * 60),
           (102, "en", "few words"), (103, "en", None), (104, "fr", prose(rng, 60)), (None, "en", prose(rng, 60)),
           (None, "en", ""), (105, "en", "Long " * 30_000 + "end")]
    df = clashing(spark.createDataFrame(rows + odd, "doc_id long, lang string, text string").repartition(3))
    got = perplexity.quality_rules(df).collect()
    assert len(got) == len(rows) + len(odd)
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    texts = dict((i, t or "") for i, _, t in rows + odd if i is not None)
    for i, r in by_id.items():
        n, chars, symbols, lines, again = brute_measure(texts[i])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, lines, again)
        assert r["base_failed"] == (n < 50 or 100 * again > 50 * n)
    # bands of what passes the rules, by hand
    for lang in ("en", None):
        passed = [r for r in got if not r["base_failed"] and r["doc_id"] is not None
                  and dict((i, x) for i, x, _ in rows + odd)[r["doc_id"]] == lang]
        passed += [r for r in got if r["doc_id"] is None and r["n_words"] and lang == "en" and not r["base_failed"]]
        bins = [round(math.log2(r["perplexity"]) * 1000) for r in passed]
        middle = np.median(bins)
        reach = 6 * max(np.median(np.abs(np.array(bins) - middle)), 10)
        for r, b in zip(passed, bins):
            assert math.log2(r["low"]) * 1000 == pytest.approx(middle - reach) and r["kept"] == (abs(b - middle) <= reach)
    assert not by_id[100]["kept"] and not by_id[100]["base_failed"] and by_id[101]["base_failed"] and by_id[104]["kept"]
    assert by_id[103]["perplexity"] is None and not by_id[103]["kept"] and by_id[103]["n_words"] == 0
    assert sum(r["kept"] for r in got) >= 60
    assert perplexity.quality_rules(df.limit(0)).count() == 0
    assert perplexity.quality_rules(df.where("doc_id = 103")).first()["low"] is None


# --- ranked search ------------------------------------------------------------------------------------


def terms(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c.isascii() and not c.isalnum():
            if word:
                out.append(word)
            word = ""
        else:
            word += c.lower() if c.isascii() else c
    return out


def brute_search(docs, items, k):
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    n, places = sum(s > 0 for *_, s in held), sum(s for *_, s in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scores = []
        for doc, c, size in held:
            if size:
                m = 75 + 25 * size * n // places
                score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                            for t in terms(text) if c[t])
                if score > 0:
                    scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def corpus_of(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Été", "été", "X-ray", "the"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs = [(i, text(rng.choice([1, 5, 30, 200]))) for i in range(150)]
    docs += [(200 + i, docs[3][1]) for i in range(30)]  # ties
    docs += [(5, docs[5][1]), (5, "w1"), (None, text(20)), (None, None), (300, ""), (301, None), (302, "w1 " * 20_000), (303, "--- ,")]
    items = [(i, text(rng.choice([1, 3, 12]))) for i in range(12)]
    items += [(12, docs[3][1]), (13, ""), (14, None), (15, "unknown words only"), (3, "w5 w6 w6"), (1, items[1][1])]
    return docs, items


@pytest.mark.parametrize("coordinates, block", [(2048, 1000), (8, 5), (1, 1000)])
def test_ranked_search(spark, coordinates, block):
    docs, items = corpus_of(3)
    got = lexical.ranked_search(
        clashing(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)),
        clashing(spark.createDataFrame(items, "item_id long, text string")).drop("item"), 7, coordinates=coordinates, block=block,
    ).select("item_id", "rank", "doc_id", "score")
    assert sorted(map(tuple, got.collect()), key=str) == brute_search(docs, [i for i in items if i[1] is not None], 7)


def test_search_of_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical.ranked_search(docs, items).count() == 0
    assert lexical.ranked_search(items.toDF("doc_id", "text"), items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
    assert lexical.ranked_search(items.toDF("doc_id", "text"), items).collect()[0][:3] == (1, 1, 1)


def test_bounds_are_upper_bounds_and_spare_documents():
    docs, items = corpus_of(4)
    counts = [Counter(lexical.terms_of(t)) for _, t in items if t]
    wanted = frozenset(t for c in counts for t in c)
    words = [lexical.terms_of(t or "") for _, t in docs]
    stats = lexical.Corpus(sum(map(bool, words)), sum(map(len, words)), Counter(t for w in words for t in wanted.intersection(w)))
    made = lexical.Items.make(range(len(counts)), counts, stats, 16)
    found = [lexical.impacts(w, made.coordinate, stats) if w else {} for w in words]
    bounds = lexical.sketch(found, made.coordinate, 16) @ made.weights
    exact = np.array([[sum(w * f.get(t, 0) for t, w in of) for of in made.terms] for f in found])
    assert (bounds >= exact).all() and (bounds > exact).any()
    scored = []
    best = lexical.Best(made, 3)
    best.offer = lambda item, score, doc, offer=best.offer: (scored.append(doc), offer(item, score, doc))[1]
    best.add([i for i, _ in docs], found)
    assert len(scored) < exact.size / 2


# --- resampling ---------------------------------------------------------------------------------------


def test_crc_matrices():
    rng = random.Random(1)
    features = [bytes(rng.randrange(256) for _ in range(rng.choice([0, 1, 2, 3, 3, 9, 255, 256, 257, 5000]))) for _ in range(400)]
    assert [int(c) for c in resampling.crcs(features)] == [crc32(f) for f in features]
    assert len(resampling.crcs([])) == 0


def brute_resample(docs, target, percent, least, buckets, shortest, longest):
    def features(text):
        w = terms(text)
        return [" ".join(w[i:i + n]).encode() for n in range(shortest, longest + 1) for i in range(len(w) - n + 1)]

    s, t = (Counter(crc32(f) % buckets for x in texts for f in features(x)) for texts in ([x for _, x in docs], target))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
    rows = []
    for i, text in docs:
        f = features(text)
        weight = sum(gain(crc32(x) % buckets) for x in f)
        h = int(sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, len(terms(text))])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for rank, r in enumerate(able[:len(able) * percent // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=str)


@pytest.mark.parametrize("percent, least, buckets, shortest, longest", [(10, 20, 10_000, 1, 1), (35, 3, 50, 1, 2), (100, 0, 7, 2, 3)])
def test_resampling(spark, percent, least, buckets, shortest, longest):
    docs, items = corpus_of(9)
    got = resampling.resample(
        clashing(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)),
        clashing(spark.createDataFrame(items, "item_id long, text string")), percent, least, buckets, shortest, longest,
    )
    want = brute_resample(docs, [t for _, t in items], percent, least, buckets, shortest, longest)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_resampling_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b " * 20)], "doc_id long, text string")
    assert resampling.resample(docs.limit(0), docs).count() == 0
    assert resampling.resample(docs, docs.limit(0), percent=100).first()["rank"] == 1


def test_ranks_of_many_ranges(spark):
    df = spark.range(2000).select(F.pmod(F.xxhash64("id"), F.lit(9)).alias("score"), "id").repartition(6)
    got = sorted(resampling.ranked(df, [F.desc("score"), F.col("id").asc_nulls_last()]).collect(), key=lambda r: r["rank"])
    assert [r["rank"] for r in got] == list(range(1, 2001))
    order = [(-r["score"], r["id"]) for r in got]
    assert order == sorted(order)
