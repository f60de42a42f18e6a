"""Rows that every operator has to take: nulls, empty and very long texts, repeated rows, clashing extra columns."""

from pyspark.sql import functions as F

LONG = " ".join(f"w{i * i}" for i in range(30_000))
DATA = [
    (1, "the quick brown fox jumps over the lazy dog", "en", "a", 43),
    (1, "the quick brown fox jumps over the lazy dog", "en", "a", 43),
    (2, None, None, None, None),
    (3, "", "en", "b", 0),
    (None, "no id at all", "en", "a", 12),
    (None, None, None, None, None),
    (4, LONG, "en", "a", len(LONG)),
    (5, " \t\n", "de", "b", 3),
    (6, "ÄÖÜ ß 😀 naïve", "de", "c", 13),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use for columns of their own.
CLASHING = (
    "fp row shard copies copy mix_key key at part slot score text_key text_size of terms h n id th pos kh ctx base rare spans"
    " sketch law size component_id order rank start crc"
).split()


def documents(spark):
    return spark.createDataFrame(DATA, SCHEMA)


def with_extras(df):
    return df.withColumns({name: F.lit(f"own {name}") for name in CLASHING})


def pairs(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
