"""Tokens, packing, SentencePiece coding, URL rules and license scans against libraries and brute force."""

import random
import struct
from fractions import Fraction
from zlib import crc32

import duckdb
import public_tokenizers
import pytest
import sentencepiece
from oracle import difference
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from labtables.llm import license_scan, packing, tokens, url_filters, viterbi

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
LONG = "the quick onhable erthing, " * 3000
TEXTS = ["", None, "a", " ", "  lead and trail  ", "one\n\ntwo\tthree", "né ▁ 漢字 🎉", "x" * 500, "<s>hi</s>",
         "<|endoftext|> and more", "It's 12'll \x1c \x00", "\xa0 no break", LONG]
ROWS = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (2, "a"), (2, "a")]
SCHEMA = "doc_id long, text string"


def messy(spark, rows=ROWS, schema=SCHEMA):
    """With further columns, whose names are those of results, and nulls in them."""
    df = spark.createDataFrame(rows, schema)
    names = ("score", "predicted", "n_tokens", "n_words", "labels", "start", "length", "tier", "key", "id", "cell")
    return df.withColumns({n: F.lit(None).cast("string") for n in names})


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def random_texts(alphabet, n=400, longest=60, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(longest))) for _ in range(n)]


def test_token_counts_equal_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = tokens.count_tokens(messy(spark), PIECES, limit=5).collect()
    got = sorted((r.doc_id is None, r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in rows)
    want = []
    for i, t in ROWS:
        n = len(library.encode(t or ""))
        want.append((i is None, i, len((t or "").encode()), n, n > 5))
    assert got == sorted(want, key=lambda r: (r[0], r[1] or 0, r[2:]))
    counter = tokens.Counter(PIECES)
    for t in random_texts("ab  the\n\t.,é▁漢\x00ing🎉 l", 2000):
        assert counter.count(t) == len(library.encode(t)), t


def test_empty_tables(spark):
    empty = messy(spark).where("false")
    assert tokens.count_tokens(empty, PIECES).count() == 0
    assert packing.pack_documents(empty, BYTES, public_tokenizers.PATTERN).count() == 0
    assert viterbi.round_trip(empty, PIECES).count() == 0
    assert license_scan.scan_licenses(empty).count() == 0
    assert url_filters.judge_urls(empty.select(F.col("doc_id").alias("page_id"), F.col("text").alias("url"))).count() == 0


def test_encoder_equals_the_library():
    library, own = Tokenizer.from_file(BYTES), packing.Encoder(BYTES, public_tokenizers.PATTERN)
    for t in [t or "" for t in TEXTS] + random_texts("ab  the\n\t.,é▁漢\x00\x1cing🎉 l'st's12\xa0 ", 3000):
        ids = ids_of(library, t)
        assert own.encode(t) == struct.pack(f"<{len(ids)}I", *ids), t


def test_units_of_letters_are_not_split_again():
    """A unit of letters is one part; whether a text needs the library is asked once for all its units."""
    library, own = Tokenizer.from_file(BYTES), packing.Encoder(BYTES, public_tokenizers.PATTERN)
    text = " Straße été " + " ".join(f"w{'a' * i} e, \u00aa\u00b5" for i in range(30))
    rest, asked = [], []
    split, plain = own.split, own.plain
    own.split = type("Split", (), {"findall": staticmethod(lambda t: rest.append(t) or split.findall(t))})
    own.plain = lambda t: asked.append(t) or plain(t)
    ids = ids_of(library, text)
    assert own.encode(text) == struct.pack(f"<{len(ids)}I", *ids)
    assert rest and all(t == " e," for t in rest) and asked == [text]


@pytest.mark.parametrize("pool", [50, 1_000_000])
def test_packing_holds_each_id_once(spark, pool):
    library = Tokenizer.from_file(BYTES)
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    out = packing.pack_documents(messy(spark, rows).repartition(3), BYTES, public_tokenizers.PATTERN,
                                 pool_tokens=pool, step=2).collect()
    pieces, sequences = {}, {}
    for r in out:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for i, t in rows:
        ids, at = [*ids_of(library, t), 0], 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            part = ids[r.start:r.start + r.length]
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == crc32(struct.pack(f"<{len(part)}I", *part))
            at += r.length
        assert at == len(ids)
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == s[0].tier <= 1024 and at & (at - 1) == 0
        assert len({r.step_id for r in s}) == 1


def test_step_groups_have_like_cost():
    packer = packing.Packer((8, 4), 0, 2)
    rng = random.Random(1)
    for i in range(60):
        n = rng.randrange(1, 9)
        packer.add((i, bytes(4 * n), n))
    rows = packer.pack(last=True)
    groups = {}
    for r in rows:
        if r[7] == 8:
            groups.setdefault(r[8], {}).setdefault(r[5], []).append(r[2] ** 2)
    costs = [sum(sum(s) for s in g.values()) for g in groups.values() if len(g) == 2]
    assert max(costs) <= 2 * min(costs)
    with pytest.raises(ValueError):
        packing.pack_documents(None, BYTES, "", tiers=(3,))


def best_path(words, text):
    """Plain dynamic programme over the whole text."""
    n, unknown = len(text), words.unknown
    best, back = [None] * (n + 1), [None] * (n + 1)
    best[0] = 0
    for i in range(n):
        if best[i + 1] is None:
            best[i + 1], back[i + 1] = best[i] + unknown, (i, [words.bytes[b] for b in text[i].encode()])
        for j in range(i + 1, min(n, i + words.longest) + 1):
            found = words.pieces.get(text[i:j])
            if found and (best[j] is None or best[i] + found[0] > best[j]):
                best[j], back[j] = best[i] + found[0], (i, [found[1]])
    out = []
    while n:
        out = back[n][1] + out
        n = back[n][0]
    return out


def test_viterbi_equals_brute_force_and_comes_back(spark):
    words = viterbi.Vocabulary(PIECES)
    for t in random_texts("ab the,.éstroing l漢\n", 600, 250):
        marked = viterbi.SPACE + t.replace(" ", viterbi.SPACE)
        ids = words.encode(t)
        want = best_path(words, marked) if t else []
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == want
        assert not t or list(words.stream(marked)) == want  # the window alone, without cuts at words
        for n in (1, 3):  # in slices
            assert not t or list(words.stream(marked[i:i + n] for i in range(0, len(marked), n))) == want
        assert words.decode(ids) == t
    assert all(r.same for r in viterbi.round_trip(messy(spark), PIECES).collect())
    plain = messy(spark).where("instr(text, '▁') = 0 OR text IS NULL")
    back = viterbi.decode(viterbi.encode(plain, PIECES), PIECES)
    key = lambda r: (r.doc_id is None, r.doc_id, r.text is None, r.text)
    assert sorted(map(key, back.collect())) == sorted(map(key, plain.select("doc_id", "text").collect()))
    assert words.decode(struct.pack("<3I", 0, 1, 99999)) == ""


def test_every_uncached_character_goes_through_the_window():
    words = viterbi.Vocabulary(PIECES)
    seen, real = [], words.stream
    words.stream = lambda text: (seen.append(text), real(text))[1]
    for t in random_texts("ab the,.éstroing l漢\n", 80, 60):
        words.units.clear(), words.parts.clear(), seen.clear()
        words.encode(t)
        marked = viterbi.SPACE + t.replace(" ", viterbi.SPACE)
        streamed, reached = set(seen), {0}
        for at in range(len(marked)):  # the text is made of what was streamed, whole parts and repeats of them
            if at in reached:
                reached |= {at + len(p) for p in streamed if marked.startswith(p, at)}
        assert len(marked) in reached or not t


def test_ties_go_to_the_longer_piece_and_windows_stay_short():
    words = viterbi.Vocabulary(PIECES)
    words.pieces = {"a": (-1.0, 1), "b": (-1.0, 2), "ab": (-2.0, 3), "ba": (-2.0, 4), "aa": (-2.0, 5), "aba": (-3.0, 6)}
    words.longest, words.trie = 3, {}
    for piece, (value, i) in words.pieces.items():
        at = words.trie
        for c in piece:
            node = at.setdefault(c, [{}, 0.0, -1])
            at = node[0]
        node[1:] = value, i
    widths, path = [], words._path
    words._path = lambda text, back, ids, at, stop: (widths.append(at - stop), path(text, back, ids, at, stop))[1]
    rng = random.Random(1)
    for _ in range(60):
        text = "".join(rng.choice("ab") for _ in range(rng.randrange(1, 700)))
        assert list(words.stream(text)) == best_path(words, text)
    assert list(words.stream("aba")) == [6] and list(words.stream("abab")) == best_path(words, "abab")
    assert max(widths) < 600


URLS = [None, "", "no scheme", "http://", "HTTP://A.NET/x", "https://example.net/en/1", "https://example.net/EN/1",
        "http://m.example.com/de/1?x=/fr/", "http://notexample.com/de/1", "http://x.org/fr/#a", "http://x.org/fr",
        "http://x.net", "http://x.net?/", "http://x.net:80/", "x://y.net/a://b.org/fr/", "http://.net/",
        "http://casino.example.com/", "http://x.com/a/tracker/b", "http://x.com/trackers", "http://é.net/\n/b"]


def test_url_rules(spark):
    df = messy(spark, list(enumerate(URLS)) + [(None, URLS[4]), (3, URLS[3])], "page_id long, url string")
    for r in url_filters.judge_urls(df).collect():
        if r.page_id is None:
            assert (r.host, r.path, r.rule, r.verdict) == ("a.net", "/x", "net/", "block")
            continue
        url = URLS[r.page_id] or ""
        rest = url.split("://", 1)[1] if "://" in url else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, tail = rest[:cut].lower() if rest[:cut].isascii() else rest[:cut], rest[cut:]
        path = tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
        assert (r.host, r.path) == (host, path)
        fits = [x for x in url_filters.BASE_RULES
                if (host == x.name.split("/")[0] or host.endswith("." + x.name.split("/")[0]))
                and path.startswith(x.name[x.name.index("/"):])]
        rule = max(fits, key=lambda x: len(x.name), default=None)
        assert r.rule == (rule and rule.name)
        spam = any(w in url_filters._TOKEN.findall(host + path) for w in url_filters.WORDS)
        assert r.verdict == (rule.action if rule else "block" if spam else "allow")


def test_rules_without_tokens_and_limits(spark):
    every = url_filters.Rule("digits", "block", r".*\d{4}", ())
    df = spark.createDataFrame([(1, "http://a.com/1234"), (2, "http://a.com/12")], "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filters.judge_urls(df, (), (every,)).collect()}
    assert got == {1: "block", 2: "allow"}
    index, rest = url_filters.build_index(url_filters.BASE_RULES, {"net": 9, "example": 5, "en": 1})
    assert rest == [] and {r.name for _, r in index["en"]} == {"example.net/en/"}
    with pytest.raises(ValueError):
        url_filters.host_rule("block", "net", "")


LICENSES = ["Released under the MIT License. Under the mit license", "cc-by.nc", "CC BY-NC 4.0", "Apache License, Version 2.0",
            "under the mit\nlicense", "Permission granted free of charge to any person obtaining a copy of this software hereby",
            "this program is free software redistribute it under the gnu general public license", "mit", "", None, "é under the mit license",
            "gnu " * 4000 + "\n" + "distributed under the gnu general public license version 3",
            "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided",
            "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General "
            "Public License as published by\nthe Free Software Foundation, either version 3 of the License",
            " ".join(f"filler{i}" for i in range(40)).join(["licensed ", " under ", " cc ", " by ", " nc ", " 4 ", " 0"]) * 20,
            "licensed under cc by nc 4 0 " * 30 + "x " * 60 + "Licensed under\nCC-BY\nNC 4"]


def plain_blocks(words, template, threshold):
    """Blocks of a template by counting every window from a word of it."""
    have = set(template.split())
    width, found = 2 * len(have), []
    for at, word in enumerate(words):
        window = [i for i in range(at, min(at + width, len(words))) if words[i] in have]
        common = len({words[i] for i in window})
        if word in have and common >= threshold * len(have):
            if found and at <= found[-1][1]:
                found[-1] = (found[-1][0], window[-1], template, max(found[-1][3], common / len(have)))
            else:
                found.append((at, window[-1], template, common / len(have)))
    return found


def test_license_scan_equals_all_pairs(spark):
    df = messy(spark, list(enumerate(LICENSES)) + [(None, LICENSES[0]), (0, LICENSES[0])])
    for threshold in (Fraction(4, 5), Fraction(1, 2), Fraction(1)):
        for r in license_scan.scan_licenses(df, threshold=threshold).collect():
            words = [w.decode() for w in license_scan.words_of(LICENSES[r.doc_id or 0] or "")]
            starts = {p: [i for i in range(len(words)) if words[i:i + len(p.split())] == p.split()] for p in license_scan.PHRASES}
            places = sorted(i for s in starts.values() for i in s)
            blocks = {b for t in license_scan.TEMPLATES for b in plain_blocks(words, t, threshold)}
            base = {license_scan.PHRASES[p] for p, s in starts.items() if s}
            assert (r.n_words, r.n_base) == (len(words), len(places))
            assert (r.first_word, r.last_word) == ((places[0], places[-1]) if places else (None, None))
            assert r.base_labels == ",".join(sorted(base))
            assert {(b.first, b.last, b.template, b.share) for b in r.blocks} == blocks and len(r.blocks) == len(blocks)
            assert r.labels == ",".join(sorted(base | {license_scan.TEMPLATES[t] for _, _, t, _ in blocks}))
            assert r.score == (1.0 if places else max((s for *_, s in blocks), default=0.0))


def test_license_text_wrapped_over_lines(spark, tmp_path):
    bsd, gpl, scattered = LICENSES[12], LICENSES[13], LICENSES[14]
    far = bsd.replace("\n", "\n" + "word " * 40)
    narrow = "x\n" * 3 + bsd.replace(" ", "\n")
    line = " ".join(["by", "under", "nc"] + ["plain"] * 7000 + ["licensed", "cc", "4", "0"])
    rows = list(enumerate([bsd, gpl, far, narrow, bsd.replace("\n", " "), scattered, line, gpl + "\n\n" + gpl, *LICENSES]))
    spark.createDataFrame([(i, t) for i, t in rows if t is not None], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    result = license_scan.scan_licenses(df)
    got = {r.doc_id: r for r in result.collect()}
    assert [got[i].labels for i in range(8)] == ["bsd", "gpl-3", "", "bsd", "bsd", "", "", "gpl-3"]
    assert got[0].score == got[3].score == got[4].score == 1.0 and got[1].score >= 0.8
    assert [(b.first, b.share) for b in got[3].blocks] == [(3, 1.0)]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert difference(result.drop("blocks"), con, license_scan.oracle()) is None

