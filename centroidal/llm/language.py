"""Language ID with language-bitmask n-gram filters.

A bit-sliced Bloom filter holds, at each position, one bit per language; the AND over an n-gram's
positions is the set of all languages that contain it. Per language the popcount over a text's
n-grams, corrected for the filter's false positives, decides.

Learning covers labelled rows of a sample bounded by ``sample_rows`` per language (in expectation,
chosen by a hash of the id; the bound is the parameter). An n-gram (3 or 4 bytes of the lower-cased
letters, words padded by blanks) enters a language's filter if it makes up at least ``MIN_RATE`` of
its n-grams - so at most 1/MIN_RATE a language reach the driver - and at least ``MIN_SHARE`` of the
rate in the language where it is most common.

Null texts and texts without a letter get ``und`` with score 0. Texts with letters but no known
n-gram get the language learned from most rows, score 0. Ties go to the first language by name.
Rows with a null id are never learned from and not held out.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from centroidal.llm.frames import crc_mod, map_batches

SIZES = (3, 4)
MIN_RATE, MIN_SHARE = 2e-5, 0.3
HASHES, BITS_PER_GRAM = 3, 16
SAMPLE_ROWS = 20_000
#: Bytes looked up at a time; longer texts are cut with an overlap, so memory stays bounded.
PIECE = 1 << 18

_WORD = re.compile(r"[^\W\d_]+")
_ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))


def letters(text: str | None) -> bytes:
    """Lower-cased words of letters, one blank around each (empty when there is no letter)."""
    words = _WORD.findall(text.lower()) if text else ()
    return f" {' '.join(words)} ".encode("utf-8", "replace") if words else b""


def grams(buffer: np.ndarray, n: int) -> np.ndarray:
    """The n-gram starting at each byte, packed with its length into one integer."""
    x = np.full(max(0, len(buffer) - n + 1), n, dtype=np.uint64)
    for i in range(n):
        x = (x << np.uint64(8)) | buffer[i:i + len(x)]
    return x


@dataclass
class LanguageFilters:
    """Bit-sliced Bloom filters: ``tables[w][position]`` has bits for languages 64 w to 64 w + 63."""

    langs: list[str]
    bits: int
    tables: list[np.ndarray]
    false_rate: np.ndarray
    default: int

    @classmethod
    def build(cls, langs: list[str], grams_of: np.ndarray, lang_of: np.ndarray, default: int) -> LanguageFilters:
        n = max(1, len(np.unique(grams_of)))
        bits = max(10, int(n * BITS_PER_GRAM - 1).bit_length())
        per_word = 8 if len(langs) <= 8 else 64
        kind = np.uint8 if per_word == 8 else np.uint64
        tables = [np.zeros(1 << bits, kind) for _ in range(-(-len(langs) // per_word))]
        fill = np.zeros(len(langs))
        for k in range(len(langs)):
            t = tables[k // per_word]
            bit = kind(1 << (k % per_word))
            for at in cls._positions(grams_of[lang_of == k], bits):
                t[at] |= bit
            fill[k] = np.count_nonzero(t & bit) / len(t)
        return cls(langs, bits, tables, fill ** HASHES, default)

    @staticmethod
    def _positions(x: np.ndarray, bits: int):
        with np.errstate(over="ignore"):
            return [(x * odd) >> np.uint64(64 - bits) for odd in _ODD]

    def counts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """For each prepared text the n-grams that each language's filter has, and all its n-grams."""
        found, total = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts))
        group: list[tuple[int, bytes]] = []
        size = 0
        for i, text in enumerate(texts):
            for s in range(0, max(1, len(text) - 2), PIECE):
                piece = text[s:s + PIECE + max(SIZES) - 1]
                group.append((i, piece))
                size += len(piece)
                if size >= PIECE:
                    self._count_group(group, found, total)
                    group, size = [], 0
        if group:
            self._count_group(group, found, total)
        return found, total

    def _count_group(self, group: list[tuple[int, bytes]], found: np.ndarray, total: np.ndarray) -> None:
        """Add the counts of pieces ``(text number, bytes)``, at most PIECE n-gram starts of each."""
        lengths = np.array([len(x) for _, x in group])
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        numbers = np.array([i for i, _ in group])
        buffer = np.frombuffer(b"".join(x for _, x in group), np.uint8)
        own = np.repeat(np.arange(len(group)), lengths)
        for n in SIZES:
            x = grams(buffer, n)
            # starts whose n-gram lies in one piece, and not in the overlap that the next piece counts
            inside = np.arange(len(x)) - starts[own[:len(x)]]
            valid = (inside <= lengths[own[:len(x)]] - n) & (inside < PIECE)
            x, of = x[valid], own[:len(x)][valid]
            np.add.at(total, numbers, np.bincount(of, minlength=len(group)))
            where = self._positions(x, self.bits)
            k = 0
            for t in self.tables:
                masks = t[where[0]] & t[where[1]] & t[where[2]]
                m = min(t.dtype.itemsize * 8, len(self.langs) - k)
                if t.dtype == np.uint8:
                    by_mask = np.bincount(of * 256 + masks, minlength=256 * len(group)).reshape(-1, 256)
                    here = by_mask @ _HAS[:, :m]
                else:
                    here = np.stack([np.bincount(of[(masks >> np.uint64(b)) & np.uint64(1) == 1], minlength=len(group))
                                     for b in range(m)], axis=1)
                np.add.at(found[:, k:k + m], numbers, here)
                k += m

    def predict_all(self, texts: list[str | None]) -> list[tuple[str, float, float]]:
        """For each text its language, score (the share of all languages' corrected counts) and the share
        of its n-grams that the language's filter knows."""
        prepared = [letters(t) for t in texts]
        found, total = self.counts(prepared)
        true = np.maximum(0.0, found - total[:, None] * self.false_rate) / (1 - np.minimum(self.false_rate, 0.999))
        every = true.sum(1)
        best = np.where(every > 0, true.argmax(1), self.default)
        top = true[np.arange(len(texts)), best]
        share = np.divide(top, every, out=np.zeros(len(texts)), where=every > 0)
        known = np.minimum(1.0, top / np.maximum(1, total))
        return [(self.langs[i], float(a), float(b)) if p else ("und", 0.0, 0.0)
                for p, i, a, b in zip(prepared, best, share, known)]


#: Whether mask m has bit b, by [m, b].
_HAS = (np.arange(256)[:, None] >> np.arange(8) & 1).astype(np.int64)


def _gram_counts(b: pa.RecordBatch) -> pa.RecordBatch:
    """Per batch and language: rows (gram 0) and n-gram counts."""
    langs, ids, counts = [], [], []
    by_lang: dict[str, list[bytes]] = {}
    rows: dict[str, int] = {}
    for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
        by_lang.setdefault(lang, []).append(letters(text))
        rows[lang] = rows.get(lang, 0) + 1
    for lang, texts in by_lang.items():
        x = np.concatenate([grams(np.frombuffer(t, np.uint8), n) for t in texts for n in SIZES])
        found, n = np.unique(x, return_counts=True)
        langs += [lang] * (len(found) + 1)
        ids += [np.zeros(1, np.uint64), found]
        counts += [np.array([rows[lang]]), n]
    return pa.RecordBatch.from_arrays(
        [pa.array(langs, pa.string()), pa.array(np.concatenate(ids).astype(np.int64)),
         pa.array(np.concatenate(counts).astype(np.int64))], names=["lang", "gram", "n"])


def fit_languages(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
                  sample_rows: int = SAMPLE_ROWS) -> LanguageFilters | None:
    """Learn the filters from rows with text and language (None when there is no such row).

    ``sample_rows``: expected most rows learned a language. Two passes: rows per language, then
    n-gram counts of the sample, summed by Spark; only n-grams over MIN_RATE reach the driver.
    """
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.col(id_col).alias("id")) \
        .filter("text is not null and lang is not null")
    per_lang = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not per_lang:
        return None
    # One row a language, as the model itself holds and sends; joined, so that any number of languages does. Without the
    # hint Spark would shuffle whole texts by language before it knows how few rows these are.
    shares = F.broadcast(docs.sparkSession.createDataFrame(
        [(lang, min(1.0, sample_rows / n)) for lang, n in per_lang.items()], "lang string, share double"))
    unit = (F.xxhash64("id").bitwiseAND(F.lit((1 << 52) - 1))).cast("double") / float(1 << 52)
    sample = rows.join(shares, "lang").filter(unit < F.col("share")).select("text", "lang")
    counted = map_batches(sample, _gram_counts, "lang string, gram long, n long") \
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    total = F.sum(F.when(F.col("gram") != 0, F.col("n"))).alias("total")
    kept = counted.filter("gram != 0").join(F.broadcast(counted.groupBy("lang").agg(total)), "lang") \
        .filter(F.col("n") >= MIN_RATE * F.col("total")).select("lang", "gram", (F.col("n") / F.col("total")).alias("rate")) \
        .toPandas()
    langs = sorted(per_lang)
    default = langs.index(max(langs, key=lambda x: (per_lang[x], [-ord(c) for c in x])))
    top = kept.groupby("gram")["rate"].transform("max")
    kept = kept[kept["rate"] >= MIN_SHARE * top]
    return LanguageFilters.build(langs, kept["gram"].to_numpy(np.int64).astype(np.uint64),
                                 kept["lang"].map({lang: i for i, lang in enumerate(langs)}).to_numpy(np.int64), default)


def identify_languages(docs: DataFrame, model: LanguageFilters | None, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """``id_col, lang_pred, score, known`` of every whole text; one row per input row. Without a
    model (nothing to learn from) every text is ``und``."""
    kept = docs.select(id_col, text_col)
    sent = kept.sparkSession.sparkContext.broadcast(model)

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        m = sent.value
        texts = b.column(1).to_pylist()
        got = m.predict_all(texts) if m else [("und", 0.0, 0.0)] * len(texts)
        cols = list(zip(*got))
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(cols[0], pa.string()), pa.array(cols[1], pa.float64()),
                                           pa.array(cols[2], pa.float64())], names=[id_col, "lang_pred", "score", "known"])

    return map_batches(kept, batch, f"`{id_col}` {kept.schema[0].dataType.simpleString()}, lang_pred string, "
                                    "score double, known double")


def keep_known_languages(docs: DataFrame, model: LanguageFilters | None, text_col: str = "text",
                         min_known: float = 0.15) -> DataFrame:
    """``docs`` without the rows that language ID rejects: null texts, texts without a letter, and
    texts of whose n-grams the best language's filter knows less than ``min_known``. Without a model
    only the first two go. Columns stay as they are."""
    at = docs.columns.index(text_col)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        m = sent.value
        texts = b.column(at).to_pylist()
        if m:
            keep = [lang != "und" and known >= min_known for lang, _, known in m.predict_all(texts)]
        else:
            keep = [bool(letters(t)) for t in texts]
        return b.filter(pa.array(keep))

    return map_batches(docs, batch, docs.schema)


def training_rows(docs: DataFrame, id_col: str = "doc_id", mod: int = 4, held: int = 2) -> DataFrame:
    """Rows that may be learned from: ``crc32(id as text) mod`` is not the held-out remainder."""
    return docs.filter(crc_mod(id_col, mod) != held)
