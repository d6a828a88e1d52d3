"""URL filter: one trie over reversed host labels and then path segments.

Rules are few and known beforehand (their number is checked before the trie is broadcast), urls are
many: every url walks the trie once. The deepest rule that fits decides between allow and block.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The rules of the registered query, as (host/path, verdict).
RULES = [
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
]

#: A trie of so many rules takes a few hundred MB at most; above this the filter refuses to broadcast.
MOST_RULES = 1_000_000

_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): host up to the first of ``/?#`` after ``://``, path up to ``?`` or ``#``.

    A url that is null or holds no ``://`` has neither.
    """
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    ends = [i for i in map(rest.find, "/?#") if i >= 0]
    at = min(ends, default=len(rest))
    path = rest[at:]
    ends = [i for i in map(path.find, "?#") if i >= 0]
    return rest[:at].translate(_LOWER), path[: min(ends, default=len(path))]


def build_trie(rules: Iterable[tuple[str, str]]) -> dict:
    """Nested dicts keyed by host label from the right, then ``("path",)``, then by path segment.

    A rule's last, unfinished segment is kept at its node as text that the rest of a path must
    start with (the empty text after a closing slash). Of equal rules, block wins.
    """
    root: dict = {}
    for rule, verdict in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"neither allow nor block: {verdict}")
        host, slash, tail = rule.partition("/")
        node = root
        for label in reversed(host.translate(_LOWER).split(".")):
            node = node.setdefault(label, {})
        node = node.setdefault(("path",), {})
        *whole, last = (slash + tail).split("/")
        for segment in whole:
            node = node.setdefault(segment, {})
        ends = node.setdefault(("ends",), {})
        if ends.get(last, ("", ""))[1] != "block":
            ends[last] = (rule, verdict)
    return root


def longest_match(trie: dict, host: str, path: str) -> tuple[str, str] | None:
    """(rule, verdict) of the fitting rule with most host labels, then with the longest path."""
    best, node = None, trie
    segments = path.split("/")
    for label in reversed(host.split(".")) if host else ():
        node = node.get(label)
        if node is None:
            break
        at, k = node.get(("path",)), 0
        here = None
        while at is not None:
            ends = at.get(("ends",))
            if ends:
                rest = "/".join(segments[k:]) if k < len(segments) else None
                fits = [e for e in ends if rest is not None and rest.startswith(e)]
                if fits:
                    here = ends[max(fits, key=len)]
            at = at.get(segments[k]) if k < len(segments) - 1 else None
            k += 1
        best = here or best
    return best


def filter_urls(
    pages: DataFrame,
    rules: Iterable[tuple[str, str]] = tuple(RULES),
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
) -> DataFrame:
    """id, host, path, rule and verdict of every row.

    Rows that no rule fits have a null rule and the ``default`` verdict; null, empty and odd urls
    have an empty host, which fits no rule. Rows are judged alone, so ties, repeats and null ids
    stay as they are; other columns are ignored; no shuffle.
    """
    rules = list(rules)
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules are too many to broadcast; the bound is {MOST_RULES}")
    trie = pages.sparkSession.sparkContext.broadcast(build_trie(rules))

    @F.pandas_udf("host string, path string, rule string, verdict string")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for urls in batches:
            rows = []
            for url in urls:
                host, path = split_url(url)
                rule, verdict = longest_match(trie.value, host, path) or (None, default)
                rows.append((host, path, rule, verdict))
            yield pd.DataFrame(rows, columns=["host", "path", "rule", "verdict"], dtype=object)

    return pages.select(F.col(id_col), judge(F.col(url_col)).alias("j")).select(id_col, "j.*")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict for the url of every page."""
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


ORACLE = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) END AS rest
  FROM pages
), split AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM cut
), rules(rule, rhost, rpath, verdict) AS (
  VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
         ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')
), fits AS (
  SELECT page_id, host, path, arg_max(rule, length(rhost) * 100000 + length(rpath)) AS rule
  FROM (SELECT s.*, row_number() OVER () AS n FROM split s)
  LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY n, page_id, host, path
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM fits
"""
