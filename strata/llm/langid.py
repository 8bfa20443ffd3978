"""Language by compression: the language whose dictionary makes a text smallest.

A zstandard raw-content dictionary is built for each language from labelled texts. A text is encoded
with each of them, in blocks, and the smallest total wins. If the margin to the next language is
narrow, it is encoded once more with a finer search; still narrow, the text says little, and the
document is rejected.
"""

from __future__ import annotations

import re
import warnings
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import by_batch

UNKNOWN = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_WORD_CHARACTER = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    return any(m.group().isalpha() for m in _WORD_CHARACTER.finditer(text or ""))


def plain(text: str) -> bytes:
    """Every distinct word of the whole text in lower case, in the order it first appears.

    Words that a page repeats hundreds of times would otherwise be coded against themselves.
    """
    return " ".join(dict.fromkeys(_NOT_LETTERS.sub(" ", text).lower().split())).encode("utf-8", "surrogatepass")


@dataclass(frozen=True)
class LanguageModel:
    """Dictionary bytes by language, the language with the most labelled rows first.

    margin: a document is rejected if its best total is less than this share below the second.
    block: bytes that are encoded at a time.
    """

    dictionaries: dict[str, bytes]
    margin: float = 0.005
    block: int = 4096

    def encoders(self) -> list[dict[str, zstandard.ZstdCompressor]]:
        """Encoders by language: fast ones, and slower ones with a finer search for texts that those leave open."""
        return [self._encoders(6, zstandard.STRATEGY_GREEDY), self._encoders(19, zstandard.STRATEGY_BTLAZY2)]

    def _encoders(self, level: int, strategy: int) -> dict[str, zstandard.ZstdCompressor]:
        out = {}
        for lang, content in self.dictionaries.items():
            params = zstandard.ZstdCompressionParameters.from_level(
                level, source_size=self.block, dict_size=len(content), strategy=strategy, min_match=3,
                write_content_size=0, write_checksum=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
            )
            shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            shared.precompute_compress(compression_params=params)
            out[lang] = zstandard.ZstdCompressor(dict_data=shared, compression_params=params)
        return out

    def predict(self, text: str | None, encoders: list[dict[str, zstandard.ZstdCompressor]]) -> tuple[str, float, bool]:
        """(language, share by which the best is below the second, rejected)."""
        if not self.dictionaries or not has_letter(text):
            return UNKNOWN, 0.0, True
        data = plain(text)
        blocks = [data[i : i + self.block] for i in range(0, len(data), self.block)]
        best, score = UNKNOWN, 0.0
        for by_language in encoders:
            sizes = {lang: sum(len(e.compress(b)) for b in blocks) for lang, e in by_language.items()}
            best = min(sizes, key=sizes.__getitem__)  # ties: the language with more labelled rows
            if len(sizes) == 1:
                return best, 1.0, False
            second = min(size for lang, size in sizes.items() if lang != best)
            score = (second - sizes[best]) / max(second, 1)
            if score >= self.margin:
                return best, score, False
        return best, score, True


def fit(docs: DataFrame, rows: int = 600, window: int = 600, size: int = 65536, total: int = 200 * 65536, least: int = 4096, margin: float = 0.005) -> LanguageModel:
    """Dictionaries from about `rows` labelled rows of each language, chosen by a hash of the id.

    Of every chosen row a window of `window` characters, placed by the hash, is read; `size` bytes
    make a dictionary. Every label is learned: all dictionaries hold `total` bytes at most, so with many
    labels each is smaller, from fewer rows; labels too many for `least` bytes each are an error. Rows
    whose crc32(doc_id) mod 5 is 0, and those without id, label or text, are never learned from; labels
    without enough letters in the others are warned of.
    """
    learn = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    counts = learn.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(total // least + 1).collect()
    if not counts:
        return LanguageModel({}, margin)
    if len(counts) > total // least:
        raise ValueError(f"more than {total // least} languages: dictionaries of {least} bytes each would exceed {total} bytes in all")
    each = min(size, total // len(counts))
    rows = max(min(rows, 32), -(-rows * each // size))  # so few that the hash may choose none would lose a label
    shares = learn.sparkSession.createDataFrame([(r["lang"], min(1.0, rows / r["count"])) for r in counts], "lang string, __share double")
    place = F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample"))
    start = F.pmod(place, F.greatest(F.length("text") - window, F.lit(0)) + 1).cast("int") + 1
    sampled = learn.select("doc_id", "text", "lang").join(F.broadcast(shares), "lang")
    chosen = sampled.where((F.pmod(place, F.lit(1 << 30)) / (1 << 30)) < F.col("__share"))
    taken = chosen.select("lang", place.alias("place"), F.substring(F.col("text"), start, F.lit(window)).alias("part")).collect()
    content = {r["lang"]: b"" for r in counts}
    for row in sorted(taken, key=lambda r: (r["place"], r["part"])):
        if len(content[row["lang"]]) < each:
            content[row["lang"]] += plain(row["part"]) + b" "
    scant = [lang for lang, data in content.items() if len(data) < 8]
    if scant:
        warnings.warn(f"{len(scant)} languages have too few letters to learn from: {', '.join(scant[:20])}")
    return LanguageModel({lang: data[:each] for lang, data in content.items() if len(data) >= 8}, margin)


def held_out():
    """True where crc32 of the id's text is divisible by 5; rows without an id are not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame, model: LanguageModel, keep: list[str]) -> DataFrame:
    """The columns `keep` of every row with lang_pred, score (0 to 1) and rejected.

    NULL texts and texts without a letter are `und` with score 0, and rejected; so is everything if
    nothing was learned. Equal texts get equal answers. Other columns are not read. `keep` may not
    name the three new columns.
    """
    fields = {f.name: f for f in docs.schema.fields}

    def make():
        encoders = model.encoders()

        def each(batch: pa.RecordBatch) -> pa.Table:
            found = [model.predict(t, encoders) for t in batch.column("__text").to_pylist()]
            columns = {c: batch.column(c) for c in keep}
            columns |= {"lang_pred": pa.array([f[0] for f in found], pa.string()), "score": pa.array([f[1] for f in found], pa.float64())}
            return pa.table(columns | {"rejected": pa.array([f[2] for f in found], pa.bool_())})

        return each

    schema = ", ".join([*(f"`{c}` {fields[c].dataType.simpleString()}" for c in keep), "lang_pred string", "score double", "rejected boolean"])
    return by_batch(docs.select(*keep, F.col("text").alias("__text")), make, schema)
