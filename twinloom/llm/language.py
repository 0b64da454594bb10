"""Language of a text, by how well it compresses with a sample of each language.

For each language a sample of its labelled texts becomes a zstandard raw-content dictionary. Samples
and texts are reduced to their letters, in lower case, with one blank between words. A text is cut into blocks, each block is compressed once with each dictionary, and the language with the
fewest bytes in all wins. The lead over the second, as a share of the fewest bytes, is the margin; a
narrow margin rejects.

Defined results: a text that is null or holds no letter is ``und`` with score 0, and rejected.
Without any labelled text all texts are ``und``. With a single language the margin is 1. Equal sizes go to the
language first in order. Copies of a text count once in a sample.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from math import exp

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageConfig:
    """A language is learned from ``rows`` distinct texts, chosen by hash, or ``dictionary_bytes``.

    Texts that would fill over a sixteenth of a dictionary are chosen only where others lack.
    """

    dictionary_bytes: int = 1 << 15
    rows: int = 400
    parts: int = 64
    most_languages: int = 1000
    block_bytes: int = 512
    level: int = 13
    least_match: int = 3
    margin: float = 0.002
    spread: float = 0.01


def letters_of(text: str | None) -> bytes:
    """Words of letters in lower case, with one blank between them."""
    return re.sub(r"[\W\d_]+", " ", (text or "").lower()).strip().encode()


def learn_dictionaries(labelled: DataFrame, config: LanguageConfig = LanguageConfig()) -> dict[str, bytes]:
    """A dictionary for each ``lang`` of ``labelled`` (``text, lang``); rows without either are left out."""
    named = labelled.select(
        F.col("lang").cast("string"), F.col("text").cast("string"),
        F.xxhash64(F.col("text").cast("string")).alias("hash"),
    ).filter("lang is not null and text is not null and text != ''")
    texts = named.groupBy("lang", "hash").agg(F.min(F.octet_length("text")).alias("size"))
    order = (F.col("size") > config.dictionary_bytes // 16, F.col("hash"))

    def first(rows: DataFrame, *by: str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        return rows.withColumn("at", place).filter(F.col("at") <= config.rows)

    # A language may have most of the texts: first the best of parts of it, then of these.
    parted = texts.withColumn("part", F.pmod("hash", F.lit(config.parts)))
    chosen = first(first(parted, "lang", "part"), "lang")
    keys = chosen.select("lang", "hash", "at").limit(config.rows * config.most_languages + 1).collect()
    if len(keys) > config.rows * config.most_languages:
        raise ValueError(f"more than {config.most_languages} languages")
    if not keys:
        return {}
    # At most rows * most_languages short keys, as counted above.
    wanted = named.sparkSession.createDataFrame(keys, "lang string, hash long, at int")
    sample = (
        named.join(F.broadcast(wanted), ["lang", "hash"])
        .groupBy("lang", "hash", "at")
        .agg(F.min(F.substring("text", 1, config.dictionary_bytes)).alias("text"))
    )
    parts: dict[str, list[tuple[int, bytes]]] = {}
    for row in sample.collect():
        if letters := letters_of(row.text):
            parts.setdefault(row.lang, []).append((row["at"], letters))
    return {
        lang: b" ".join(text for _, text in sorted(parts[lang]))[: config.dictionary_bytes]
        for lang in sorted(parts)
    }


def language_of(
    text: Column, dictionaries: dict[str, bytes], config: LanguageConfig = LanguageConfig()
) -> Column:
    """``lang, score, margin, rejected`` of each text."""

    @F.pandas_udf("lang string, score double, margin double, rejected boolean")
    def identify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        langs = list(dictionaries)
        compress = []
        for lang in langs:
            sample = zstandard.ZstdCompressionDict(
                dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT
            )
            how = zstandard.ZstdCompressionParameters.from_level(
                config.level, min_match=config.least_match, write_content_size=0, write_dict_id=0
            )
            sample.precompute_compress(compression_params=how)
            compress.append(zstandard.ZstdCompressor(compression_params=how, dict_data=sample).compress)

        def one(text: str | None) -> tuple[str, float, float, bool]:
            if not langs or text is None or not any(map(str.isalpha, text)):
                return UNKNOWN, 0.0, 0.0, True
            raw = letters_of(text)
            blocks = [raw[at : at + config.block_bytes] for at in range(0, len(raw), config.block_bytes)]
            sizes = [sum(len(f(block)) for block in blocks) for f in compress]
            least = min(sizes)
            best = sizes.index(least)
            others = sizes[:best] + sizes[best + 1 :]
            margin = (min(others) - least) / least if others else 1.0
            score = 1 / (1 + sum(exp((least - size) / (config.spread * least)) for size in others))
            return langs[best], score, margin, margin < config.margin

        for batch in batches:
            yield pd.DataFrame(
                [one(text) for text in batch], columns=["lang", "score", "margin", "rejected"]
            )

    return identify(text.cast("string"))
