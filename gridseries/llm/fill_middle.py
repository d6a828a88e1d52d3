"""Fill-in-middle: texts cut at unit ends into prefix, middle and suffix, and put in another order.

Where units end is a matter of character classes: lines end with a line feed, sentences with a stop or a line
feed, and so on. A wavelet matrix over the classes of all texts of a chunk answers how many characters of a
class stand before a place (rank). The ranks of the classes that end units add up to the number of ends; the
place of the k-th end is found by select where one class ends units, else by bisection on the added ranks.
All texts of a chunk are asked at once.

Texts are turned where they lie: nothing is shuffled, and a chunk is bounded but for a longer text, which is
one alone. The way back (:func:`restore`) is one SQL expression.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

#: Character classes; every other ASCII character is of class 0 and all others of class 7.
OTHER, LINE_FEED, BLANK, STOP, DIGIT, UPPER, LOWER, BEYOND = range(8)
_ASCII = np.array(
    [LINE_FEED if c == "\n" else BLANK if c in " \t\v\f\r" else STOP if c in ".!?" else DIGIT if c.isdigit() else UPPER if c.isupper() else LOWER if c.islower() else OTHER for c in map(chr, range(128))]
    + [BEYOND],
    np.uint8,
)

#: Classes whose characters end a unit. A last unit may lack its end.
UNITS = {"line": (LINE_FEED,), "sentence": (LINE_FEED, STOP), "word": (LINE_FEED, BLANK), "character": tuple(range(8))}

#: Characters of a chunk.
CHUNK = 1 << 21


def classes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the characters of all texts, and where each text begins and the last one ends."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return _ASCII[np.minimum(codes, 128)], np.cumsum([0, *map(len, texts)])


class WaveletMatrix:
    """Rank and select of the symbols 0 to 2^levels - 1 of a sequence, by one bit vector for each level."""

    def __init__(self, symbols: np.ndarray, levels: int = 3):
        self.size, self.levels = len(symbols), levels
        #: ones before each place, and the number of zeros, level by level from the highest bit
        self.ones, self.zeros = [], []
        for bit in range(levels - 1, -1, -1):
            high = (symbols >> bit & 1).astype(bool)
            self.ones.append(np.concatenate([[0], np.cumsum(high, dtype=np.int32)]).astype(np.int32))
            self.zeros.append(self.size - int(self.ones[-1][-1]))
            symbols = np.concatenate([symbols[~high], symbols[high]])

    def _down(self, level: int, symbol: int, place: np.ndarray) -> np.ndarray:
        ones = self.ones[level][place]
        return self.zeros[level] + ones if symbol >> (self.levels - 1 - level) & 1 else place - ones

    def rank(self, symbol: int, place: np.ndarray) -> np.ndarray:
        """How many of the symbol stand before each place."""
        first, place = np.zeros(1, np.int64), np.asarray(place)
        for level in range(self.levels):
            first, place = self._down(level, symbol, first), self._down(level, symbol, place)
        return place - first

    def select(self, symbol: int, k: np.ndarray) -> np.ndarray:
        """The place of the k-th of the symbol (k from 1; there must be so many)."""
        first = np.zeros(1, np.int64)
        for level in range(self.levels):
            first = self._down(level, symbol, first)
        place = first + np.asarray(k) - 1
        for level in range(self.levels - 1, -1, -1):
            ones = self.ones[level]
            if symbol >> (self.levels - 1 - level) & 1:
                # the j-th one of this level, j from 0: the last place with no more than j ones before it
                place = np.searchsorted(ones, place - self.zeros[level], "right") - 1
            else:
                place = _bisect(lambda at, ones=ones: at - ones[at], place + 1, np.zeros_like(place), np.full_like(place, self.size)) - 1
        return place


def _bisect(count, least: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The first place from ``low`` to ``high`` whose ``count`` (which never falls) reaches ``least``."""
    low, high = low.copy(), high.copy()
    while (low < high).any():
        mid = (low + high) // 2
        enough = count(mid) >= least
        high, low = np.where(enough, mid, high), np.where(enough, low, np.minimum(mid + 1, high))
    return low


class Cutter:
    """Units of the texts of a chunk."""

    def __init__(self, texts: list[str], unit: str):
        symbols, edges = classes(texts)
        self.ends = UNITS[unit]
        self.start, self.stop = edges[:-1], edges[1:]
        self.matrix = WaveletMatrix(symbols)
        self.before = self._ends_before(self.start)
        self.ended = self._ends_before(self.stop) - self.before
        # a text whose last character ends no unit has one unit more
        last = self._ends_before(self.stop) - self._ends_before(np.maximum(self.stop - 1, self.start))
        self.units = self.ended + ((self.stop > self.start) & (last == 0))

    def _ends_before(self, place: np.ndarray) -> np.ndarray:
        return sum(self.matrix.rank(symbol, place) for symbol in self.ends)

    def cut(self, k: np.ndarray) -> np.ndarray:
        """How many characters the first ``k`` units of each text have."""
        inside = (k > 0) & (k <= self.ended)
        at = np.where(k > 0, self.stop, self.start)
        if inside.any():
            wanted = (self.before + k)[inside]
            if len(self.ends) == 1:
                at[inside] = self.matrix.select(self.ends[0], wanted) + 1
            else:
                at[inside] = _bisect(self._ends_before, wanted, self.start[inside], self.stop[inside])
        return at - self.start


def draws(id_col: Column, seed: int = 7) -> list[Column]:
    """Four numbers of 32 bits for an id (a null one counts as an empty string): the first four groups of
    eight digits of the SHA-256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def transform(
    docs: DataFrame, unit: str = "line", rate: int = 100, spm_rate: int = 50, seed: int = 7, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row.

    ``n`` is the number of units. The prefix ends after the smaller and the middle after the larger of two
    drawn numbers of units. ``form`` is ``plain`` if the text is empty or null, holds one of the marks or is
    not among ``rate`` percent; else ``spm`` (suffix first) in ``spm_rate`` percent, or ``psm``. Plain rows
    keep their text and have null cuts. Repeated rows come out alike; null ids draw as an empty id; other
    columns, whatever their names, are left behind; an empty table gives an empty one.
    """
    if unit not in UNITS:
        raise ValueError(f"no unit {unit}; there are {', '.join(UNITS)}")
    key = F.col(f"`{id_col}`").cast("long")
    rows = docs.select(key.alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"), *[h.alias(f"h{k}") for k, h in enumerate(draws(key, seed), 1)])

    def chunk(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = part.column("text").to_pylist()
        cutter = Cutter(texts, unit)
        h1, h2, h3, h4 = (part.column(f"h{k}").to_numpy(zero_copy_only=False) for k in (1, 2, 3, 4))
        n = cutter.units
        a, b = h1 % (n + 1), h2 % (n + 1)
        to, upto = cutter.cut(np.minimum(a, b)), cutter.cut(np.maximum(a, b))
        out, forms = [], []
        for text, i, j, whole, spm in zip(texts, to.tolist(), upto.tolist(), (h3 % 100 >= rate).tolist(), (h4 % 100 < spm_rate).tolist(), strict=True):
            if whole or not text or PREFIX in text or SUFFIX in text or MIDDLE in text:
                forms.append("plain")
                out.append(text)
            else:
                forms.append("spm" if spm else "psm")
                prefix, suffix = PREFIX + text[:i], SUFFIX + text[j:]
                out.append("".join((suffix, prefix, MIDDLE, text[i:j]) if spm else (prefix, suffix, MIDDLE, text[i:j])))
        plain = np.array([f == "plain" for f in forms], bool)
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(forms, pa.string()), pa.array(to, pa.int64(), mask=plain), pa.array(upto - to, pa.int64(), mask=plain), pa.array(out, pa.string())],
            names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, held = 0, 0
            for k, size in enumerate(pa.compute.binary_length(batch.column("text")).to_pylist()):
                if held and held + size > CHUNK:
                    yield chunk(batch.slice(first, k - first))
                    first, held = k, 0
                held += size
            if batch.num_rows > first:
                yield chunk(batch.slice(first))

    return rows.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made of. No mark can arise where a part meets a mark: marks begin with
    ``<``, end with ``>`` and hold neither inside."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    first, second, last = (F.get(part, k) for k in (1, 2, 3))
    return F.when(form == "plain", output).when(form == "psm", F.concat(first, last, second)).otherwise(F.concat(second, last, first))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, lengths and digests of every document's output, and of the text rebuilt from it."""
    made = transform(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
h AS (SELECT doc_id, text, lines, len(lines) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
k AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM h),
c AS (SELECT doc_id, n, text, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
             array_to_string(lines[1:a], '') AS p, array_to_string(lines[a + 1:b], '') AS m, array_to_string(lines[b + 1:], '') AS s FROM k)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM c
"""
