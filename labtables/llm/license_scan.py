"""License scan: exact phrases, and a set-similarity join of text blocks with templates (operator 10).

A window is a run of twice as many words as a template has, wherever lines end. The join finds every
window that holds at least a given share of a template's distinct words; windows that overlap make one
block. Words have one global order, rarest in all documents first. A template's prefix is so long that a
window without any word of it cannot hold the share, so texts look up their words in an index of the
prefixes; the length filter and the positional filter drop candidates before windows are counted.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from fractions import Fraction
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = Fraction(4, 5)
STRETCH = 2
MAX_TEMPLATES = 10_000

# Base phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Lines by which well-known licenses are declared; own choice.
TEMPLATES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "this work is licensed under a creative commons attribution noncommercial license": "cc-by-nc",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by",
    "this program is free software you can redistribute it under the gnu general public license version 3": "gpl-3",
    "distributed under the gnu general public license version 3": "gpl-3",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this source code form is subject to the terms of the mozilla public license version 2 0": "mpl-2",
}

# Bytes that separate words become spaces, A-Z become a-z.
_WORD = [48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)]
_TABLE = bytes((b | 32 if 65 <= b <= 90 else b) if _WORD[b] else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    """Words of a text: runs of 0-9, a-z and non-ASCII characters."""
    return text.encode().translate(_TABLE).split()


def places(words: Sequence[bytes], phrases: Mapping[bytes, str]) -> tuple[list[int], list[str]]:
    """Word numbers at which a phrase starts, and the labels of those that occur."""
    joined = b" " + b" ".join(words) + b" "
    starts, labels = [], []
    for phrase, label in phrases.items():
        at = joined.find(phrase)
        if at >= 0:
            labels.append(label)
        while at >= 0:
            starts.append(joined.count(b" ", 0, at + 1) - 1)
            at = joined.find(phrase, at + 1)
    return starts, labels


class Index:
    """Templates by the words of their prefixes; ``order`` numbers the words, rarest first."""

    def __init__(self, templates: Mapping[str, str], counts: Mapping[bytes, int], threshold: Fraction, stretch: int = STRETCH):
        sets = [(frozenset(t.encode().split()), label) for t, label in templates.items()]
        vocabulary = sorted({w for words, _ in sets for w in words}, key=lambda w: (counts.get(w, 0), w))
        self.order = {w: i for i, w in enumerate(vocabulary)}
        self.wanted = frozenset(vocabulary)
        self.stretch = stretch
        self.templates = []
        self.prefixes: dict[int, list[tuple[int, int]]] = {}
        for number, (words, label) in enumerate(sets):
            ranks = sorted(self.order[w] for w in words)
            need = ceil(threshold * len(ranks))
            self.templates.append((ranks, need, label))
            for position, rank in enumerate(ranks[:len(ranks) - need + 1]):
                self.prefixes.setdefault(rank, []).append((number, position))

    def candidates(self, present: Sequence[int]) -> Iterator[int]:
        """Templates that a text with these words (ascending numbers) may hold enough of."""
        tried = set()
        for at, rank in enumerate(present):
            for number, position in self.prefixes.get(rank, ()):
                if number not in tried:
                    tried.add(number)  # the first common word in the global order
                    template, need, _ = self.templates[number]
                    if len(present) >= need and min(len(present) - at, len(template) - position) >= need:
                        yield number

    def blocks(self, words: Sequence[bytes]) -> Iterator[tuple[int, int, int, Fraction]]:
        """(first word, last word, template, share) of every block: the windows that hold enough of a template,
        from a word of the template to the last one in reach, merged where they overlap."""
        present = sorted(map(self.order.__getitem__, self.wanted.intersection(words)))
        chosen = list(self.candidates(present)) if present else []
        if not chosen:
            return
        held = [(at, self.order[w]) for at, w in enumerate(words) if w in self.wanted]
        for number in chosen:
            template, need, _ = self.templates[number]
            mine = frozenset(template)
            places = [(at, rank) for at, rank in held if rank in mine]
            width, end, block = self.stretch * len(template), 0, None
            inside: Counter = Counter()
            for at, rank in places:
                while end < len(places) and places[end][0] < at + width:
                    inside[places[end][1]] += 1
                    end += 1
                if len(inside) >= need:
                    last, share = places[end - 1][0], Fraction(len(inside), len(template))
                    if block and at <= block[1]:
                        block = (block[0], last, number, max(block[3], share))
                    else:
                        if block:
                            yield block
                        block = (at, last, number, share)
                inside[rank] -= 1
                if not inside[rank]:
                    del inside[rank]
            if block:
                yield block


def word_counts(texts: DataFrame, wanted: frozenset[bytes]) -> dict[bytes, int]:
    """Texts that hold each word of the templates; at most one row a word to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                found.update(wanted.intersection(words_of(text.as_py() or "")))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["word", "n"]
        )

    rows = texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {bytes(r["word"]): r["n"] for r in rows}


def scan_licenses(df: DataFrame, phrases: Mapping[str, str] = PHRASES, templates: Mapping[str, str] = TEMPLATES,
                  threshold: Fraction = THRESHOLD, id_col: str = "doc_id", text_col: str = "text",
                  stretch: int = STRETCH) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score, blocks) for each row.

    ``n_base`` counts all places of phrases, ``first_word`` and ``last_word`` are the smallest and largest
    word number at which one starts (null without any). ``blocks`` lists (first, last, template, share) of
    all blocks that meet the threshold, by word numbers, with the largest share of a window in them;
    windows have ``stretch`` times as many words as the template has different ones. ``score`` is 1 with a
    phrase, else the largest share, else 0. Labels are distinct, sorted and joined by commas, empty if
    there are none. A null text counts as empty. Frequencies are counted over all rows in a pass of its
    own; each row is then judged where it is read.
    """
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    rows = df.select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").alias("text"))
    wanted = frozenset(w for t in templates for w in t.encode().split())
    index = Index(templates, word_counts(rows.select("text"), wanted), threshold, stretch)
    sought = {f" {p} ".encode(): label for p, label in phrases.items()}
    names = list(templates)
    id_type = rows.schema[id_col].dataType.simpleString()
    block_type = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("template", pa.string()), ("share", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(1):
                words = words_of(text.as_py() or "")
                starts, base = places(words, sought)
                blocks = sorted(index.blocks(words))
                labels = {*base, *[index.templates[t][2] for _, _, t, _ in blocks]}
                out.append((
                    len(words), len(starts), min(starts, default=None), max(starts, default=None),
                    ",".join(sorted(set(base))), ",".join(sorted(labels)),
                    1.0 if starts else float(max((s for *_, s in blocks), default=0)),
                    [{"first": a, "last": b, "template": names[t], "share": float(s)} for a, b, t, s in blocks],
                ))
            columns = list(zip(*out)) if out else [()] * 8
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), block_type]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                names=[id_col, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
                       "blocks"],
            )

    return rows.mapInArrow(
        run, f"`{id_col}` {id_type}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
             "labels string, score double, blocks array<struct<first: bigint, last: bigint, template: string, share: double>>"
    )


def oracle() -> str:
    """DuckDB SQL for the rows of ``scan_licenses`` over ``documents`` with the lists above, without ``blocks``."""
    phrases = ", ".join(f"('{p}', '{label}')" for p, label in PHRASES.items())
    templates = ", ".join(f"('{t}', '{label}')" for t, label in TEMPLATES.items())
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
    WITH phrases(phrase, label) AS (VALUES {phrases}), templates(template, label) AS (VALUES {templates}),
    docs AS (SELECT doc_id, {low} AS low, regexp_extract_all({low}, '{word}') AS words FROM documents),
    placed AS (SELECT doc_id, label, i FROM docs, phrases, unnest(range(1, len(words) + 1)) AS t(i)
               WHERE contains(low, split_part(phrase, ' ', 1))
                 AND words[i:i + len(string_split(phrase, ' ')) - 1] = string_split(phrase, ' ')),
    base AS (SELECT doc_id, count(*) AS n_base, min(i) - 1 AS first_word, max(i) - 1 AS last_word FROM placed GROUP BY 1),
    lex AS (SELECT template, label, unnest(list_distinct(string_split(template, ' '))) AS word,
                   len(list_distinct(string_split(template, ' '))) AS size FROM templates),
    occ AS (SELECT doc_id, template, label, size, word, i FROM
            (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM docs) JOIN lex USING (word)),
    enough AS (SELECT doc_id, template FROM occ GROUP BY doc_id, template, size HAVING count(DISTINCT word) * 5 >= size * 4),
    near AS (SELECT occ.* FROM occ JOIN enough USING (doc_id, template)),
    held AS (SELECT a.doc_id, a.label, a.size, count(DISTINCT b.word) AS common
             FROM near a JOIN near b ON a.doc_id = b.doc_id AND a.template = b.template AND b.i >= a.i AND b.i < a.i + {STRETCH} * a.size
             GROUP BY a.doc_id, a.template, a.label, a.size, a.i),
    found AS (SELECT doc_id, label, common / size AS share FROM held WHERE common * 5 >= size * 4),
    tags AS (SELECT doc_id, label, true AS is_base, 1.0 AS share FROM placed
             UNION ALL SELECT doc_id, label, false, share FROM found),
    joined AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
                      string_agg(DISTINCT label, ',' ORDER BY label) FILTER (is_base) AS base_labels,
                      max(share) AS score FROM tags GROUP BY 1)
    SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
           last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
           coalesce(score, 0.0)::DOUBLE AS score
    FROM docs d LEFT JOIN base USING (doc_id) LEFT JOIN joined USING (doc_id)
    """
