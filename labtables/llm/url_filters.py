"""URL rules indexed by their rarest literal token (operator 9).

A rule is a regular expression on ``host + path``. The index files each rule under that one of its
literal tokens that the fewest URLs hold; a URL's tokens fetch their rules, and only those run their
expressions. Frequencies are counted over all URLs, for the tokens of the rules only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RULES = 100_000
_TOKEN = re.compile("[A-Za-z0-9]+")


@dataclass(frozen=True)
class Rule:
    """``name`` is what a verdict cites; ``tokens`` stand whole in each URL that ``pattern`` matches."""

    name: str
    action: str
    pattern: str
    tokens: tuple[str, ...]


def host_rule(action: str, host: str, path: str) -> Rule:
    """A rule for a host with its subdomains and the start of a path that ends at a slash."""
    if not path.endswith("/"):
        raise ValueError("the path of a host rule ends with a slash")
    pattern = rf"(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}"
    return Rule(host + path, action, pattern, tuple(_TOKEN.findall(host + path)))


def word_rule(action: str, word: str) -> Rule:
    """A rule for a word that stands as a token of its own anywhere in host or path."""
    return Rule(word, action, rf".*(?<![A-Za-z0-9]){re.escape(word)}(?![A-Za-z0-9])", (word,))


# Fixed values of the base list.
BASE_RULES = (
    host_rule("block", "net", "/"),
    host_rule("allow", "example.net", "/en/"),
    host_rule("block", "example.com", "/de/"),
    host_rule("allow", "org", "/fr/"),
)

# Words that decide where no base rule fits; own choice.
WORDS = ("adserver", "affiliate", "banner", "casino", "doubleclick", "poker", "porn", "spam", "tracker", "xxx")
WORD_RULES = tuple(word_rule("block", w) for w in WORDS)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://``, A-Z in lower case, and the path; both empty if there is no ``://``."""
    found = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.when(found, F.substr(url, F.instr(url, "://") + F.lit(3))).otherwise(F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), upper, lower)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def token_counts(urls: DataFrame, tokens: Sequence[str]) -> dict[str, int]:
    """Number of URLs (rows of ``host``, ``path``) with each of the tokens; one row a token to the driver."""
    wanted = F.array(*[F.lit(t) for t in tokens])
    have = F.array_intersect(F.regexp_extract_all(F.concat("host", "path"), F.lit(r"([A-Za-z0-9]+)"), 1), wanted)
    rows = urls.select(F.explode(have).alias("token")).groupBy("token").count().collect()
    return {t: 0 for t in tokens} | {r["token"]: r["count"] for r in rows}


def build_index(rules: Sequence[Rule], counts: dict[str, int]) -> tuple[dict[str, list], list]:
    """Rules by their rarest token, and those without any token, which every URL has to try."""
    index: dict[str, list] = {}
    rest = []
    for order, rule in enumerate(rules):
        entry = (order, rule)
        if rule.tokens:
            index.setdefault(min(rule.tokens, key=lambda t: (counts.get(t, 0), t)), []).append(entry)
        else:
            rest.append(entry)
    return index, rest


def judge_urls(df: DataFrame, base: Sequence[Rule] = BASE_RULES, more: Sequence[Rule] = WORD_RULES,
               id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """(id, host, path, rule, verdict, more_rule) for each row.

    Of the base rules that fit, the one with the longest name decides and is cited in ``rule``. Without
    one, the longest fitting rule of ``more`` gives the verdict and is cited in ``more_rule`` (ties: the
    earlier one), else ``default`` holds. A null URL, or one without ``://``, has empty host and path and
    fits no rule with a token. There is a row out for each row in; other columns are not read. The lists
    hold at most ``MAX_RULES`` rules together, as they travel to every task.
    """
    if len(base) + len(more) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    host, path = host_and_path(F.col(url_col).cast("string"))
    urls = df.select(F.col(id_col).alias(id_col), host.alias("host"), path.alias("path"))
    names = sorted({t for r in (*base, *more) for t in r.tokens})
    counts = token_counts(urls, names) if names else {}
    lists = [build_index(rules, counts) for rules in (base, more)]
    id_type = urls.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled: dict[str, re.Pattern] = {}

        def best(lookup: tuple[dict, list], tokens: set[str], text: str) -> Rule | None:
            index, rest = lookup
            found = list(rest)
            for token in tokens & index.keys():
                found += index[token]
            fitting = []
            for order, rule in found:
                pattern = compiled.get(rule.pattern)
                if pattern is None:
                    pattern = compiled[rule.pattern] = re.compile(rule.pattern, re.DOTALL)
                if pattern.match(text):
                    fitting.append((-len(rule.name), order, rule))
            return min(fitting, key=lambda f: f[:2])[2] if fitting else None

        for batch in batches:
            out = []
            for host, path in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                text = host + path
                tokens = set(_TOKEN.findall(text))
                rule = best(lists[0], tokens, text)
                other = None if rule else best(lists[1], tokens, text)
                decides = rule or other
                out.append((rule and rule.name, decides.action if decides else default, other and other.name))
            columns = list(zip(*out)) if out else [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), *[pa.array(c, pa.string()) for c in columns]],
                names=[id_col, "host", "path", "rule", "verdict", "more_rule"],
            )

    return urls.mapInArrow(
        run, f"`{id_col}` {id_type}, host string, path string, rule string, verdict string, more_rule string"
    )


def oracle() -> str:
    """DuckDB SQL for the rows of ``judge_urls`` over ``pages`` with the lists above."""
    fits = " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}'"
        for h, p in sorted(((r.name[:r.name.index('/')], r.name[r.name.index('/'):]) for r in BASE_RULES),
                           key=lambda r: -len(r[0] + r[1]))
    )
    action = " ".join(f"WHEN '{r.name}' THEN '{r.action}'" for r in BASE_RULES)
    words = " ".join(
        f"WHEN regexp_matches(host || path, '(^|[^A-Za-z0-9]){w}([^A-Za-z0-9]|$)', 's') THEN '{w}'"
        for w in sorted(WORDS, key=lambda w: (-len(w), WORDS.index(w)))
    )
    return f"""
    WITH cut AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
                 FROM pages),
    parts AS (SELECT page_id,
                     translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                               'abcdefghijklmnopqrstuvwxyz') AS host,
                     regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
    judged AS (SELECT *, CASE {fits} END AS rule FROM parts),
    more AS (SELECT *, CASE WHEN rule IS NULL THEN CASE {words} END END AS more_rule FROM judged)
    SELECT page_id, host, path, rule,
           CASE WHEN rule IS NOT NULL THEN CASE rule {action} END
                WHEN more_rule IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict, more_rule
    FROM more
    """
