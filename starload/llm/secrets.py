"""Secret scans: patterns, and character Markov models of random strings and of ordinary identifiers.

Two first-order models over an alphabet of 66 symbols are counted from labelled samples: the values that the
patterns find in the corpus are the random class, long tokens of the shape of identifiers the ordinary one. A token whose
log-likelihood ratio passes the threshold is a secret too. The counts are summed by Spark over all texts;
two tables of 66 by 66 numbers reach the driver.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.common import prepared

#: The patterns of the base spans.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "markov")

#: Ordinary identifiers: words of one case, or with a capital first, and short numbers.
ORDINARY = re.compile(r"(?:[_/=+-]*+(?>[A-Z]?[a-z]{3,}+|[A-Z]{3,}+|[0-9]{1,4}+(?![0-9])))++[_/=+-]*+")
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Place 0 stands before and after a token, and for any other character.
SIZE = len(ALPHABET) + 1
CODES = np.zeros(256, np.int64)
CODES[[ord(c) for c in ALPHABET]] = np.arange(1, SIZE)
#: A token is taken for random above so many nats, and so many a character.
NATS, NATS_PER_CHAR = 10.0, 0.35
EVEN = 5.0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the pattern matches, in code points, by start and then kind."""
    found = []
    lower = text.lower()
    if any(k in lower for k in KEYWORDS):
        found += [(*m.span(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(*m.span(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(*m.span(), 2) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], s[2], s[1]))


def _values(text: str, spans: list[tuple[int, int, int]]) -> list[str]:
    """What is secret in the spans: of an assignment, the right-hand side."""
    return [ASSIGN.match(text, a).group(2) if kind == 0 else text[a:b] for a, b, kind in spans]


def _free_tokens(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Long tokens that meet no span."""
    tokens = [m.span() for m in TOKEN.finditer(text)]
    return [(a, b) for a, b in tokens if not any(s < b and a < e for s, e, _ in spans)] if spans else tokens


def pair_counts(tokens: list[str]) -> np.ndarray:
    """How often each symbol follows each other one, the borders included."""
    codes = CODES[np.frombuffer(("\n" + "\n".join(tokens) + "\n").encode("ascii", "replace"), np.uint8)]
    return np.bincount(codes[:-1] * SIZE + codes[1:], minlength=SIZE * SIZE)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = np.zeros((2, SIZE * SIZE), np.int64)
    for batch in batches:
        samples: tuple[list[str], list[str]] = ([], [])
        for text in batch.column(0).to_pylist():
            if text:
                spans = base_spans(text)
                samples[1].extend(_values(text, spans))
                samples[0].extend(text[a:b] for a, b in _free_tokens(text, spans) if ORDINARY.fullmatch(text, a, b))
        for k in (0, 1):
            if samples[k]:
                sums[k] += pair_counts(samples[k])
    k, pair = np.nonzero(sums)
    yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(pair), pa.array(sums[k, pair])], names=["secret", "pair", "n"])


def log_odds(ordinary: np.ndarray, random: np.ndarray) -> np.ndarray:
    """For each pair of symbols, how much likelier the second follows the first in a random string.

    Letters and digits drawn evenly are a sample of random strings too, ``EVEN`` of each pair; they stand for
    the kinds that no pattern knows. All other pairs are smoothed by one half.
    """
    out = []
    for counts, even in ((ordinary, 0.0), (random, EVEN)):
        table = counts.reshape(SIZE, SIZE) + 0.5
        table[:63, 1:63] += even
        table[:, 0] += 0.5
        out.append(np.log(table / table.sum(axis=1, keepdims=True)))
    return out[1] - out[0]


def fit(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The log odds of symbol pairs, counted over every text of ``docs``."""
    prepared(docs.sparkSession)
    counted = docs.select(text).mapInArrow(_counts, "secret long, pair long, n long")
    sums = np.zeros((2, SIZE * SIZE))
    for row in counted.groupBy("secret", "pair").agg(F.sum("n").alias("n")).collect():  # 2 * 67 * 67 rows at most
        sums[row.secret, row.pair] = row.n
    return log_odds(sums[0], sums[1])


def ratio(token: str, odds: np.ndarray) -> float:
    """Log-likelihood ratio of a token: above zero it looks random."""
    codes = CODES[np.frombuffer(f"\n{token}\n".encode("ascii", "replace"), np.uint8)]
    return float(odds[codes[:-1], codes[1:]].sum())


def all_spans(text: str, odds: np.ndarray) -> list[tuple[int, int, int]]:
    """Base spans, and the long tokens apart from them that look random."""
    spans = base_spans(text)
    free = _free_tokens(text, spans)
    if free:
        codes = CODES[np.frombuffer(("\n" + "\n".join(text[a:b] for a, b in free) + "\n").encode("ascii", "replace"), np.uint8)]
        steps = odds[codes[:-1], codes[1:]]
        borders = np.concatenate(([0], np.cumsum([b - a + 1 for a, b in free])[:-1]))
        sums = np.add.reduceat(np.append(steps, 0.0), borders)
        spans = spans + [(a, b, 3) for (a, b), x in zip(free, sums) if x >= NATS and x >= NATS_PER_CHAR * (b - a)]
    return sorted(spans, key=lambda s: (s[0], s[2], s[1]))


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, b, kind in spans)


def scan(docs: DataFrame, odds: np.ndarray) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_markov, base_sha256, spans) for every row of ``docs`` (doc_id, text).

    Offsets are code points. A null text counts as an empty one, which has no spans; repeated rows give
    repeated results.
    """
    prepared(docs.sparkSession)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [all_spans(t, odds) if t else [] for t in batch.column(1).to_pylist()]
            counts = [pa.array([sum(s[2] == k for s in spans) for spans in found], pa.int64()) for k in range(4)]
            base = [hashlib.sha256(_listed([s for s in spans if s[2] < 3]).encode()).hexdigest() for spans in found]
            spans = pa.array([_listed(spans) for spans in found], pa.string())
            names = ["doc_id", "n_assign", "n_access", "n_hex", "n_markov", "base_sha256", "spans"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, pa.array(base, pa.string()), spans], names=names)

    schema = "doc_id long, n_assign long, n_access long, n_hex long, n_markov long, base_sha256 string, spans string"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scanned, schema)
