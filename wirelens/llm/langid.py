"""Language identification by compression: per-language zstandard raw-content dictionaries, the smallest size wins.

Texts without a letter (null and empty ones too) are ``und``. Equal sizes fall to the language with more training
rows, with margin 0. Rows with a null language teach nothing; with no language at all every text is ``und``. Repeated rows are
predicted one by one, further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._text import bounded

UND = "und"
#: Level of compression, the same for texts of all lengths.
LEVEL = 12
#: Bytes of all dictionaries together; beyond it each gets an equal part.
DICTIONARIES_BYTES = 64 << 20


def fold_of(key: str, n: int) -> Column:
    """crc32 of the key as text, modulo n; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % n


def clean(column: pa.Array) -> pa.Array:
    """Lower case, letters only, other runs as one space."""
    return pc.replace_substring_regex(pc.utf8_lower(column.fill_null("")), r"[^\p{L}]+", " ")


class Classifier:
    """One dictionary a language; a text is compressed in chunks against each, and margins compare total sizes.

    ``languages`` maps each language to its dictionary, the most frequent one first: of equal sizes the first wins.
    """

    def __init__(self, languages: dict[str, bytes], chunk: int = 1500, level: int = LEVEL):
        self.languages, self.chunk, self.level = dict(languages), chunk, level
        self._tools: list = []

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_tools": []}

    def tools(self) -> list:
        if not self._tools:
            for d in self.languages.values():
                words = zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                words.precompute_compress(level=self.level)
                self._tools.append(zstandard.ZstdCompressor(dict_data=words, level=self.level, write_content_size=False, write_checksum=False, write_dict_id=False).compress)
        return self._tools

    def sizes(self, text: bytes) -> list[int]:
        parts = [text[i : i + self.chunk] for i in range(0, len(text), self.chunk)]
        return [sum(len(f(p)) for p in parts) for f in self.tools()]

    def predict(self, text: bytes) -> tuple[str, float, float]:
        """(language, score, margin): the score is the share of the winner under 2^(-bytes / 4), the margin the runner-up's excess in size."""
        if not text.strip() or not self.languages:
            return UND, 0.0, 0.0
        found = self.sizes(text)
        best = min(found)
        at = found.index(best)
        second = min([s for i, s in enumerate(found) if i != at], default=2 * best)
        score = 1.0 / sum(2.0 ** (max(-200.0, (best - s) / 4)) for s in found)
        return list(self.languages)[at], score, (second - best) / best


def train(docs: DataFrame, slots: int = 64, dictionary_bytes: int = 48_000) -> Classifier:
    """Dictionaries from at most ``slots`` whole documents a language, ``dictionary_bytes`` bytes each.

    Every labelled row competes: rows fall into slots by a hash of doc_id and each slot keeps the least hash, which
    combines before the shuffle. Only those documents' texts come to the driver. Dictionaries of very many languages
    are shorter, so that all together stay within DICTIONARIES_BYTES.
    """
    mark = F.xxhash64(F.lit(6), F.col("doc_id"))
    rows = docs.filter("lang is not null and text is not null").select("doc_id", "lang", "text", mark.alias("mark"))
    slots_of = rows.groupBy("lang", F.pmod("mark", F.lit(slots)).alias("slot")).agg(F.min("mark").alias("mark"), F.count("*").alias("n")).collect()
    seen: dict[str, int] = {}
    for r in slots_of:
        seen[r["lang"]] = seen.get(r["lang"], 0) + r["n"]
    if not seen:
        return Classifier({})
    chosen = docs.sparkSession.createDataFrame([(r["lang"], r["mark"]) for r in slots_of], "lang string, mark long")
    texts = rows.join(F.broadcast(chosen), ["lang", "mark"], "left_semi").groupBy("lang", "mark").agg(F.min("text").alias("text")).toArrow()
    found: dict[str, list[bytes]] = {}
    texts = texts.sort_by([("lang", "ascending"), ("mark", "ascending")])
    for lang, text in zip(texts.column("lang").to_pylist(), clean(texts.column("text").combine_chunks()).to_pylist()):
        found.setdefault(lang, []).append(text.encode())
    dictionary_bytes = min(dictionary_bytes, DICTIONARIES_BYTES // len(found))
    made = {lang: fair(found[lang], dictionary_bytes) for lang in sorted(found, key=lambda x: (-seen[x], x))}
    return Classifier({lang: d for lang, d in made.items() if d.strip()})


def fair(parts: list[bytes], most: int) -> bytes:
    """At most ``most`` bytes of all parts: a level is found so that longer parts give that many bytes and others all."""
    left, out = most, []
    for i, p in enumerate(sorted(parts, key=len)):
        take = min(len(p), left // (len(parts) - i))
        left -= take
        out.append(p[:take])
    return b" ".join(out)


def identify(docs: DataFrame, model: Classifier, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, margin) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                found = [shared.value.predict(t.encode()) for t in clean(part.column(text)).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(key), *[pa.array([f[i] for f in found], t) for i, t in enumerate((pa.string(), pa.float64(), pa.float64()))]], names=[key, "lang_pred", "score", "margin"])

    return docs.select(key, text).mapInArrow(run, f"{key} {docs.schema[key].dataType.simpleString()}, lang_pred string, score double, margin double")


def keep_identified(docs: DataFrame, least_margin: float) -> DataFrame:
    """``docs`` without those that are rejected: no letters, or a margin under ``least_margin``."""
    model = train(bounded(docs))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                found = [shared.value.predict(t.encode()) for t in clean(part.column("text")).to_pylist()]
                yield part.filter(pa.array([f[0] != UND and f[2] >= least_margin for f in found]))

    return docs.mapInArrow(run, docs.schema)
