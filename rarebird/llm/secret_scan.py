"""Secret scan: fixed patterns, then a battery of randomness tests on every long token.

*Patterns.* ``assign`` (a credential's name, ``:`` or ``=``, a value of 12 or more), ``access`` (an access
key id of 18 or more) and ``hex`` (16 or more hexadecimal digits): leftmost non-overlapping per kind.

*Battery.* Every maximal run of 16 or more characters of ``A-Za-z0-9+/_-`` that no pattern's span holds is
a token. Its encoding is the smallest alphabet of ``ENCODINGS`` with all its characters. Three tests ask
whether the token could be drawn uniformly from that alphabet: chi-squared (two-sided), runs above and
below the alphabet's middle, and the lag-1 serial correlation of the characters' places; the least of
the three p-values times three is the token's (Bonferroni, as the tests are not independent). Below
``RANDOM_P`` the token is not random.

*False discoveries.* A short token of an ordinary word or path may pass. What an ordinary token of the
same length and encoding looks like follows from the corpus itself: the characters of all texts,
counted, give the shares f of the alphabet's symbols, and the number of equal pairs among L symbols
drawn by f has a known mean and deviation. The token's own number of equal pairs (its chi-squared is a
linear function of it) gives the chance that an ordinary one looks as even as this. Benjamini-Hochberg at
``FALSE_SHARE`` decides which tokens are secrets, separately for every encoding and power of two
of the length, so that many short tokens cannot use up the allowance of the long ones, nor hide behind them.
The chances are rounded up to 1/100 of a standard deviation, which keeps the control valid and bounds
what the driver reads: a count per encoding, length class and step.

Three narrow passes (symbol counts, spans, verdicts over a written table); nothing is shuffled but
counts. Offsets are code points, ends exclusive.

Edge cases: a null text is empty, an empty one has no span; ids may be null or repeat, every row is judged
by its own text; an empty table gives an empty result; a corpus whose symbols already are even (random
digits, say) gives no discovery, as nothing tells its tokens apart; only the named columns are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rarebird.llm.common import Scratch, byte_buffer, bytes_of, steps

KINDS = ["assign", "access", "hex", "random"]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_NAMES = [b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key"]
MIN_VALUE, MIN_ACCESS, MIN_HEX, MIN_TOKEN = 12, 18, 16, 16
#: p-value below which a token is not random, and allowed share of ordinary tokens among those reported
RANDOM_P, FALSE_SHARE = 0.01, 0.05

_DIGIT, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: alphabets by size, symbols in the order of their values
ENCODINGS = {
    "decimal": _DIGIT,
    "hex": _DIGIT + "abcdef",
    "HEX": _DIGIT + "ABCDEF",
    "lower": _LOWER,
    "upper": _UPPER,
    "base32": _UPPER + "234567",
    "base36": _DIGIT + _LOWER,
    "BASE36": _DIGIT + _UPPER,
    "base62": _UPPER + _LOWER + _DIGIT,
    "base64": _UPPER + _LOWER + _DIGIT + "+/",
    "base64url": _UPPER + _LOWER + _DIGIT + "-_",
    "any": _UPPER + _LOWER + _DIGIT + "+/-_",
}
_SIZES = np.array([len(a) for a in ENCODINGS.values()])
#: place of each byte in each alphabet (-1: not in it), and the alphabets of each byte as bits
_PLACE = np.full((len(ENCODINGS), 256), -1, np.int64)
for _k, _alphabet in enumerate(ENCODINGS.values()):
    _PLACE[_k, list(_alphabet.encode())] = np.arange(len(_alphabet))
_HELD_BY = ((_PLACE >= 0) << np.arange(len(ENCODINGS))[:, None]).sum(0)
_STEP = 100  # steps of a standard deviation
_FAR = 40 * _STEP


def _charset(chars: str) -> np.ndarray:
    held = np.zeros(256, bool)
    held[list(chars.encode())] = True
    return held


_HEX, _CAPITAL, _TOKEN = _charset(ENCODINGS["hex"]), _charset(_UPPER + _DIGIT), _charset(ENCODINGS["any"])


def char_runs(data: np.ndarray, offsets: np.ndarray, held: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every maximal run of ``least`` or more bytes of a set; runs end with their row."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = held[data]
    cut = np.zeros(len(data) + 1, bool)  # a row begins at this byte
    cut[offsets] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
    long = ends - starts >= least
    return starts[long], ends[long]


def _normal_tail(z: np.ndarray) -> np.ndarray:
    """P(Z >= z) of a standard normal."""
    return np.array([0.5 * math.erfc(x / math.sqrt(2)) for x in z.tolist()])


def battery(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Encoding, equal pairs among the symbols, and combined p-value of randomness of each token."""
    n, length = len(starts), ends - starts
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    token = np.repeat(np.arange(n), length)
    first = np.cumsum(length) - length
    at = np.arange(len(token)) - np.repeat(first, length) + np.repeat(starts, length)
    symbols = data[at]
    held = np.bitwise_and.reduceat(_HELD_BY[symbols], first)
    encoding = np.log2((held & -held).astype(float)).astype(np.int64)  # the lowest bit: the smallest alphabet
    size = _SIZES[encoding].astype(float)
    value = _PLACE[encoding[token], symbols]

    counts = np.unique(token * 256 + value, return_counts=True)
    squares = np.bincount(counts[0] // 256, counts[1].astype(float) ** 2, n)
    pairs = ((squares - length) / 2).astype(np.int64)
    chi2 = squares * size / length - length
    # Wilson-Hilferty: the cube root of a chi-squared variable over its degrees is nearly normal
    spread = 2 / (9 * (size - 1))
    z_chi2 = (np.cbrt(chi2 / (size - 1)) - (1 - spread)) / np.sqrt(spread)

    high = value * 2 >= size[token]
    above = np.bincount(token, high, n)
    next_same = token[1:] == token[:-1]
    changes = np.bincount(token[1:], next_same & (high[1:] != high[:-1]), n)
    mean = 2 * above * (length - above) / length
    with np.errstate(divide="ignore", invalid="ignore"):
        z_runs = np.where(mean > 1, (changes - mean) / np.sqrt(np.maximum(mean * (mean - 1) / (length - 1), 1e-12)), np.inf)
        off = value - (np.bincount(token, value, n) / length)[token]
        power = np.bincount(token, off * off, n)
        lagged = np.bincount(token[1:], next_same * off[1:] * off[:-1], n)
        z_serial = np.where(power > 0, (lagged / power + 1 / length) * np.sqrt(length), np.inf)
    least = np.max(np.abs([z_chi2, z_runs, z_serial]), axis=0)
    return encoding, pairs, np.minimum(1.0, 6 * _normal_tail(least))


def _base_spans(text: bytes) -> list[tuple[int, int, int]]:
    """``assign`` spans of one text, in code points."""
    lowered = text.lower()
    if not any(name in lowered for name in ASSIGN_NAMES):
        return []
    return [(0, m.start(), m.end()) for m in ASSIGN.finditer(text.decode("utf-8", "replace")) if len(m[2]) >= MIN_VALUE]


def _step_spans(texts: pa.Array) -> tuple[list[list[tuple]], list[list[tuple]]]:
    """Per row: base spans (kind, start, end) and tokens (start, end, encoding, length, pairs, p)."""
    data, offsets = byte_buffer(texts)
    rows = len(offsets) - 1
    base: list[list[tuple]] = [_base_spans(t) for t in texts.to_pylist()]
    tokens: list[list[tuple]] = [[] for _ in range(rows)]
    if not len(data):
        return base, tokens
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before each byte

    def placed(starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int, int]]:
        row = np.searchsorted(offsets, starts, side="right") - 1
        zero = points[offsets[row]]
        return zip(row.tolist(), (points[starts] - zero).tolist(), (points[ends] - zero).tolist())

    found: list[tuple[int, int]] = []
    for start, end in zip(*(x.tolist() for x in char_runs(data, offsets, _CAPITAL, MIN_ACCESS))):
        at = data[start:end].tobytes().find(b"AKIA")
        if at >= 0 and end - start - at >= MIN_ACCESS:
            found.append((start + at, end))
    if found:
        for row, start, end in placed(*np.array(found, np.int64).T):
            base[row].append((1, start, end))
    for row, start, end in placed(*char_runs(data, offsets, _HEX, MIN_HEX)):
        base[row].append((2, start, end))
    for spans in base:
        spans.sort(key=lambda s: (s[1], s[0]))

    starts, ends = char_runs(data, offsets, _TOKEN, MIN_TOKEN)
    encoding, pairs, p = battery(data, starts, ends)
    for k, (row, start, end) in enumerate(placed(starts, ends)):
        if not any(s <= start and end <= e for _, s, e in base[row]):
            tokens[row].append((start, end, int(encoding[k]), end - start, int(pairs[k]), float(p[k])))
    return base, tokens


_SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("kind", T.IntegerType()), T.StructField("end", T.LongType())])
_TOKEN_TYPE = T.StructType([
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("encoding", T.IntegerType()),
    T.StructField("length", T.LongType()), T.StructField("pairs", T.LongType()), T.StructField("p", T.DoubleType())])


def symbol_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """How often each byte occurs in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, np.int64)
        for batch in batches:
            for step in steps(batch):
                total += np.bincount(byte_buffer(step.column("text"))[0], minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(range(256), pa.int32()), pa.array(total)], names=["b", "n"])

    out = np.zeros(256, np.int64)
    counted = docs.select(bytes_of(f"`{text}`").alias("text")).mapInArrow(run, "b int, n long")
    for row in counted.groupBy("b").agg(F.sum("n").alias("n")).collect():
        out[row["b"]] = row["n"]
    return out


def ordinary(counts: np.ndarray) -> list[tuple[float, float]]:
    """Sums of squares and of cubes of the shares of each encoding's symbols (even ones where none occurs)."""
    out = []
    for k, size in enumerate(_SIZES.tolist()):
        share = counts[np.flatnonzero(_PLACE[k] >= 0)].astype(float)
        share = share / share.sum() if share.sum() else np.full(size, 1 / size)
        out.append((float((share**2).sum()), float((share**3).sum())))
    return out


def ordinary_steps(token: Column, moments: list[tuple[float, float]]) -> Column:
    """Deviations, in steps rounded up, of a token's equal pairs from those of an ordinary token of its length
    and encoding; ``_FAR`` for a token that is not random."""
    lookup = lambda j: F.get(F.array(*[F.lit(m[j]) for m in moments]), token["encoding"])
    two, three, n = lookup(0), lookup(1), token["length"].cast("double")
    all_pairs = n * (n - 1) / 2
    variance = all_pairs * (two - two * two) + n * (n - 1) * (n - 2) * F.greatest(three - two * two, F.lit(0.0))
    z = (token["pairs"] - all_pairs * two) / F.sqrt(F.greatest(variance, F.lit(1e-9)))
    step = F.ceil(F.least(F.greatest(z, F.lit(-40.0)), F.lit(40.0)) * _STEP).cast("int")
    return F.when(token["p"] >= RANDOM_P, step).otherwise(F.lit(_FAR))


def stratum(token: Column) -> Column:
    """Encoding and power of two of the length as one number."""
    return token["encoding"] * 64 + F.floor(F.log2(token["length"].cast("double"))).cast("int")


def limits(counted: list[tuple[int, int, int]], false_share: float = FALSE_SHARE) -> dict[int, int]:
    """Benjamini-Hochberg: the greatest step that is a discovery in each stratum, from rows (stratum, step, tokens)."""
    by: dict[int, list[tuple[int, int]]] = {}
    for s, step, n in counted:
        by.setdefault(s, []).append((step, n))
    out = {}
    for s, found in by.items():
        total, upto = sum(n for _, n in found), 0
        for step, n in sorted(found):
            upto += n
            chance = 0.5 * math.erfc(-step / _STEP / math.sqrt(2))
            if step < _FAR and chance * total <= false_share * upto:
                out[s] = step
    return out


def find_spans(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, ``base`` spans (start, kind, end) and ``tokens`` with their battery. One narrow stage."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("base", T.ArrayType(_SPAN)),
                           T.StructField("tokens", T.ArrayType(_TOKEN_TYPE))])
    span = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
    token = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("encoding", pa.int32()), ("length", pa.int64()),
                       ("pairs", pa.int64()), ("p", pa.float64())])
    names = [f.name for f in token]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch, "__text"):
                base, tokens = _step_spans(step.column("__text"))
                yield pa.RecordBatch.from_arrays([
                    step.column(0),
                    pa.array([[{"start": s, "kind": k, "end": e} for k, s, e in spans] for spans in base], pa.list_(span)),
                    pa.array([[dict(zip(names, t)) for t in row] for row in tokens], pa.list_(token)),
                ], names=[id_col, "base", "tokens"])

    return docs.select(F.col(f"`{id_col}`"), bytes_of(f"`{text}`").alias("__text")).mapInArrow(run, schema)


def spans_text(spans: Column) -> Column:
    """kind:start:end by start, then kind, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", false_share: float = FALSE_SHARE) -> DataFrame:
    """Per document: id, n_assign, n_access, n_hex, base_sha256, spans (base ones and the battery's ``random``)."""
    scratch = Scratch(docs.sparkSession)
    moments = ordinary(symbol_counts(docs, text))
    found = scratch.keep(find_spans(docs, id_col, text), "spans")
    listed = found.select(F.explode("tokens").alias("t")).select(
        stratum(F.col("t")).alias("s"), ordinary_steps(F.col("t"), moments).alias("step"))
    counted = [(r["s"], r["step"], r["n"]) for r in listed.groupBy("s", "step").agg(F.count(F.lit(1)).alias("n")).collect()]
    most = limits(counted, false_share)
    if most:
        table = F.create_map(*[F.lit(x) for pair in sorted(most.items()) for x in pair])
        secret = F.filter("tokens", lambda t: ordinary_steps(t, moments) <= F.coalesce(F.try_element_at(table, stratum(t)), F.lit(-_FAR - 1)))
    else:
        secret = F.filter("tokens", lambda t: F.lit(False))
    added = F.transform(secret, lambda t: F.struct(t["start"].alias("start"), F.lit(3).alias("kind"), t["end"].alias("end")))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        F.col(f"`{id_col}`"), count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
        spans_text(F.concat("base", added)).alias("spans"))
