"""Licence scan: canonical text digests, hash-joined with the digests of known licence texts.

Native: one SQL expression makes the canonical text, so the same definition serves Spark, the known
texts and the checking SQL. Each document gives its whole text and each of its lines to the look-up;
both are compared entire, by digest.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridseries.llm.license_texts import full_texts

#: Equivalent spellings, as pattern and replacement, applied in this order to
#: lower-case text in which every other run of characters is one blank.
SPELLINGS = [
    (r"\blicence", "license"),
    (r"\blicences", "licenses"),
    (r"\blicenced\b", "licensed"),
    (r"\bsub license", "sublicense"),
    (r"\bcopyright holder\b", "copyright owner"),
    (r"\bcopyright holders\b", "copyright owners"),
    (r"\bnon commercial", "noncommercial"),
    (r"\bmerchantibility\b", "merchantability"),
    (r"\bgnu gpl\b", "gnu general public license"),
    (r"\bversion (\d+) 0\b", r"version \1"),
    (r"\bv(\d+) 0\b", r"version \1"),
    (r"\bhttps? ", "http "),
]

#: Public licence notices and licence texts, by SPDX id.
KNOWN = [
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("WTFPL", "Do what the fuck you want to public license. Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("MIT-0", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so."),
]
# the notices above are lines or paragraphs; these are the whole texts
KNOWN += full_texts()

#: The known digests are broadcast; so many take a few MB.
MOST_KNOWN = 20_000

#: Statements of copyright, which are dropped. The first three are told by their own words wherever they stand, so
#: it does not matter where the lines of running text break: a year and a company, a form to be filled in, and the
#: same without brackets. The others are whole lines that name a holder: a sign or year follows, a year stands
#: later in the line, or nothing but names do. "Copyright license", "copyright holder" and the like stay.
_GAP = r"[ \t\r\n]"
_SIGN = rf"copyright{_GAP}*(?:\(c\)|©)?{_GAP}*"
_LINE = r"^[^\p{L}\p{N}\n©]*"
STATEMENTS = [
    rf"(?i){_SIGN}[0-9]{{4}}(?:[ \t\r\n,–-]+[0-9]{{4}})*{_GAP}+(?:[\p{{L}}&'’.,-]+{_GAP}+){{0,8}}?(?:inc|ltd|llc|corp|gmbh)\b\.?,?(?:{_GAP}*<[^<>]{{0,80}}>)?",
    rf"(?i){_SIGN}(?:[<\[{{][^<>\[\]{{}}]{{1,80}}[>\]}}]{_GAP}*){{1,3}}",
    rf"(?i)copyright{_GAP}*\(c\){_GAP}*year{_GAP}+name{_GAP}+of{_GAP}+author",
    rf"(?im){_LINE}(?:(?:\(c\)[ \t]*)?copyright[ \t]*(?:\(c\)|©|:|[0-9])|©)[^\n]*$",
    rf"(?m){_LINE}(?:Copyright|COPYRIGHT)[ \t]+(?:by[ \t]+)?\p{{Lu}}[^\n]*\b(?:19|20)[0-9]{{2}}\b[^\n]*$",
    rf"(?m){_LINE}Copyright(?:[ \t]+(?:by[ \t]+)?\p{{Lu}}[\p{{L}}.,&'’-]*){{1,6}}[ \t\r]*$",
]


def _bound(value: Column, of: Callable[[Column], Column]) -> Column:
    """``of`` a value that it may name several times, computed once."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def _needed(pattern: str) -> str:
    """The longest run of letters and blanks that whatever a spelling's pattern matches must hold."""
    plain = re.sub(r"\(\\d\+\)|\\b|.\?", "\n", pattern)
    return max(plain.split("\n"), key=len)


def canonical(text: Column) -> Column:
    """Canonical form of a text: see the module; null stays null, a text without words is empty.

    Rules are tried only on texts that hold what they need (a plain search, much cheaper than a pattern).
    """

    def without_statements(whole: Column) -> Column:
        out = whole
        for pattern in STATEMENTS:
            # in Java's patterns only a line feed ends a line if (?d) is set
            out = F.regexp_replace(out, pattern.replace("m)", "md)", 1) if "m)" in pattern[:5] else pattern, " ")
        return F.when(F.contains(F.lower(whole), F.lit("copyright")) | F.contains(whole, F.lit("©")), out).otherwise(whole)

    out = F.trim(F.regexp_replace(F.lower(_bound(text, without_statements)), r"[^\p{L}\p{N}]+", " "))

    def spelt(pattern: str, spelling: str) -> Callable[[Column], Column]:
        return lambda x: F.when(F.contains(x, F.lit(_needed(pattern))), F.regexp_replace(x, pattern, spelling.replace("\\1", "$1"))).otherwise(x)

    for pattern, spelling in SPELLINGS:
        out = _bound(out, spelt(pattern, spelling))
    return out


def known_digests(spark: SparkSession, known: list[tuple[str, str]]) -> DataFrame:
    """(license, digest) of the known texts; of texts with one canonical form the first id stays."""
    if len(known) > MOST_KNOWN:
        raise ValueError(f"{len(known)} licence texts are too many to broadcast; the bound is {MOST_KNOWN}")
    texts = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(known)], "n int, license string, text string")
    return (
        texts.withColumn("digest", F.md5(canonical(F.col("text"))))
        .groupBy("digest").agg(F.min_by("license", "n").alias("license"))
    )


def scan(
    docs: DataFrame,
    known: list[tuple[str, str]] = KNOWN,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """id, ``digest`` (md5 of the canonical text), ``license`` (of the whole text, or null),
    ``line_licenses`` (sorted, comma-joined, of its lines, or null) and ``n_lines`` that matched.

    Rows are told apart by id and text: rows that repeat both come out once each with equal
    results. Null texts count as empty; an empty canonical text matches nothing. Null ids are kept.
    Other columns are ignored. Only lines that matched are shuffled.
    """
    digests = known_digests(docs.sparkSession, known)
    whole, by_line = (digests.select(F.col("digest").alias(f"{n}_digest"), F.col("license").alias(n)) for n in ("whole", "line"))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    lines = (
        rows.select("id", F.xxhash64("text").alias("key"), F.explode(F.split("text", "\n")).alias("line"))
        .select("id", "key", F.md5(canonical(F.col("line"))).alias("line_digest"))
        .join(F.broadcast(by_line), "line_digest")
        .groupBy("id", "key", "line").count()
        .groupBy("id", "key").agg(
            F.array_join(F.sort_array(F.collect_set("line")), ",").alias("line_licenses"), F.sum("count").alias("n")
        )
        .withColumnsRenamed({"id": "line_id", "key": "line_key"})
    )
    # rows that repeat an id and text were counted together above
    scanned = (
        rows.select("id", F.xxhash64("text").alias("key"), F.md5(canonical(F.col("text"))).alias("digest"))
        .join(F.broadcast(whole), F.col("digest") == F.col("whole_digest"), "left")
    )
    copies = scanned.groupBy("id", "key", "digest", "whole").agg(F.count("*").alias("copies"))
    joined = copies.join(lines, copies["id"].eqNullSafe(lines["line_id"]) & (copies["key"] == lines["line_key"]), "left")
    return joined.select(
        F.col("id").alias(id_col),
        "digest",
        F.col("whole").alias("license"),
        "line_licenses",
        F.coalesce(F.col("n") / F.col("copies"), F.lit(0)).cast("long").alias("n_lines"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    ).drop("copy")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document's whole text, and of its lines."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql_canonical(text: str) -> str:
    out = text
    for pattern in STATEMENTS:
        quoted = pattern.replace("'", "''")
        out = f"regexp_replace({out}, '{quoted}', ' ', 'g')"
    out = f"trim(regexp_replace(lower({out}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
    for pattern, spelling in SPELLINGS:
        out = f"regexp_replace({out}, '{pattern}', '{spelling}', 'g')"
    return out


ORACLE = f"""
WITH known AS (
  SELECT md5({_sql_canonical('t')}) AS digest, arg_min(license, n) AS license
  FROM (VALUES {', '.join("(%d, '%s', '%s')" % (i, k, t.replace("'", "''")) for i, (k, t) in enumerate(KNOWN))}) v(n, license, t)
  GROUP BY 1
), rows AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), lines AS (
  SELECT r, license FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM rows)
  JOIN known ON digest = md5({_sql_canonical('line')})
), per AS (
  SELECT r, string_agg(DISTINCT license, ',' ORDER BY license) AS line_licenses, count(*) AS n_lines FROM lines GROUP BY r
), whole AS (
  SELECT r, doc_id, md5({_sql_canonical('text')}) AS digest FROM rows
)
SELECT doc_id, digest, license, line_licenses, coalesce(n_lines, 0) AS n_lines
FROM whole LEFT JOIN known USING (digest) LEFT JOIN per USING (r)
"""
