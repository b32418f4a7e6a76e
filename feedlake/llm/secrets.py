"""Secret scan: known patterns, and a randomness test battery on other long tokens.

Every candidate token is read in each encoding that spells it (hexadecimal, base 32, base 36, base
62 or base 64; a token with dashes or underscores also without them), and its symbols are tested
against uniform draws from that encoding's alphabet: chi-squared for the shares of symbols, runs of
capitals, small letters, digits and signs, and serial correlation of neighbours. The same three statistics have a distribution for ordinary text, too, taken from the
letter pairs of the whole corpus. The ratio of the two likelihoods is an e-value against "ordinary
text"; a reading in which the battery rejects randomness has none, and a token has the greatest of
its readings divided by their number, which is an e-value, too. It grows with the token's length,
so short tokens need more. Tokens of any length are reported by the e-BH procedure over all
candidates, which holds the false-discovery rate whatever depends on what.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import chunks, strings
from feedlake.plans.shared import settle

# The patterns asked for, in the order in which kinds are listed.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a match is a whole run, so a short one need not be found
SHORTEST = {"assign": 6, "access": 20}
KINDS = ("assign", "access", "hex", "random")

CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z+/_-]*+[0-9][A-Za-z0-9+/_-]*={0,2}")
RATE = 0.05  # false discoveries among the reported, on average
REJECT = 1e-3  # a reading is no random one if the battery gives less than this
NOTHING = -1e6  # logarithm of the e-value of a rejected reading
_SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
# Alphabets by name, symbols in the order of their numbers.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "BASE36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": _SYMBOLS,
}
SPREAD = 0.2  # deviation, between ordinary tokens, of how often the kind of symbol changes
_KEYWORDS = ("pass", "secret", "token", "api")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind, end) of what the three patterns find, leftmost per kind."""
    found = []
    low = text.lower()
    if any(word in low for word in _KEYWORDS):
        for match in ASSIGN.finditer(text):
            if len(match[2]) >= SHORTEST["assign"]:
                found.append((match.start(), 0, match.end()))
    if "AKIA" in text:
        for match in ACCESS.finditer(text):
            if match.end() - match.start() >= SHORTEST["access"]:
                found.append((match.start(), 1, match.end()))
    for match in HEX.finditer(text):
        found.append((match.start(), 2, match.end()))
    return sorted(found)


def encodings(token: str) -> list[tuple[str, str, np.ndarray]]:
    """Every encoding with digits and letters that spells the token, what it spells, and its parts.

    Parts are numbered for each symbol; what meets across a separator is no pair of neighbours.

    Dashes and underscores are symbols of base 64, and separators in the other encodings.
    """
    body = token.rstrip("=")
    if not any(c.isdigit() for c in body) or not any(c.isalpha() for c in body):
        return []
    signed, joined = body.translate(_URL_SAFE), body.translate(_JOINED)
    apart = np.array([c in "-_" for c in body])
    parts, whole = np.cumsum(apart)[~apart], np.zeros(len(body), int)
    out = []
    for name, alphabet in ALPHABETS.items():
        spelled, part = (signed, whole) if name == "base64" else (joined, parts)
        if set(spelled) <= _SETS[name]:
            out.append((name, spelled, part))
    return out


_SETS = {name: set(alphabet) for name, alphabet in ALPHABETS.items()}
_JOINED = str.maketrans("", "", "-_")
_URL_SAFE = str.maketrans("-_", "+/")


def _kinds(alphabet: str) -> np.ndarray:
    """Capital, small letter, digit or sign, for each symbol."""
    return np.array([0 if c.isupper() else 1 if c.islower() else 2 if c.isdigit() else 3 for c in alphabet])


def statistics(spelled: str, name: str, part: np.ndarray) -> tuple[int, float, float, float]:
    """Neighbours, chi-squared of the symbols' shares, changes of kind, serial correlation."""
    alphabet = ALPHABETS[name]
    values = np.array([alphabet.index(c) for c in spelled])
    length, size = len(values), len(alphabet)
    counts = np.bincount(values, minlength=size)
    chi = float(((counts - length / size) ** 2).sum() * size / length)
    kinds = _kinds(alphabet)[values]
    near = part[1:] == part[:-1]
    runs = int(((np.diff(kinds) != 0) & near).sum())
    middle = values - (size - 1) / 2
    serial = float((middle[:-1] * middle[1:])[near].sum() / (middle**2).sum())
    return int(near.sum()), chi, float(runs), serial


def _pair_codes() -> np.ndarray:
    table = np.full(256, 64, np.uint8)
    for place, symbol in enumerate(_SYMBOLS):
        table[ord(symbol)] = place
    return table


_PAIRS = _pair_codes()


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per document with its base spans and candidates, and rows of letter pairs.

    Rows with ``pair`` carry counts of neighbouring symbols in ordinary text; they have no document.
    """

    def run(batches):
        for batch in batches:
            data, bounds = strings(batch.column(text))
            pairs = np.zeros(65 * 65, np.int64)
            for low, high in chunks(bounds):
                codes = _PAIRS[data[bounds[low] : bounds[high]]].astype(np.int64)
                codes[(bounds[low:high] - bounds[low])[bounds[low:high] < bounds[high]]] = 64
                pairs += np.bincount(codes[:-1] * 65 + codes[1:], minlength=65 * 65)
            bases, tokens, apart = [], [], []
            for value in batch.column(text):
                own = value.as_py() or ""
                bases.append(
                    [{"start": s, "kind": k, "end": e} for s, k, e in base_spans(own)]
                )
                tokens.append(list(_candidates(own)))
                apart += [own[token["start"] : token["end"]] for token in tokens[-1]]
            # What may be random is no ordinary text.
            codes = _PAIRS[np.frombuffer(" ".join(apart).encode(), np.uint8)].astype(np.int64)
            inside = (codes[:-1] < 64) & (codes[1:] < 64)
            pairs -= np.bincount(codes[:-1][inside] * 65 + codes[1:][inside], minlength=65 * 65)
            rows = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(bases, _BASES),
                    pa.array(tokens, _TOKENS),
                    pa.nulls(rows, pa.int32()),
                    pa.nulls(rows, pa.int64()),
                ],
                ["doc_id", "base", "tokens", "pair", "n"],
            )
            met = np.flatnonzero(pairs)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(len(met), pa.int64()),
                    pa.nulls(len(met), _BASES),
                    pa.nulls(len(met), _TOKENS),
                    pa.array(met.astype(np.int32)),
                    pa.array(pairs[met]),
                ],
                ["doc_id", "base", "tokens", "pair", "n"],
            )

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text)
    return narrow.mapInArrow(
        run,
        "doc_id bigint, base array<struct<start:bigint,kind:int,end:bigint>>, "
        "tokens array<struct<start:bigint,end:bigint,readings:array<struct<encoding:string,"
        "length:int,neighbours:int,chi:double,runs:double,serial:double>>>>, pair int, n bigint",
    )


_BASES = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
_READINGS = pa.list_(
    pa.struct(
        [
            ("encoding", pa.string()),
            ("length", pa.int32()),
            ("neighbours", pa.int32()),
            ("chi", pa.float64()),
            ("runs", pa.float64()),
            ("serial", pa.float64()),
        ]
    )
)
_TOKENS = pa.list_(
    pa.struct([("start", pa.int64()), ("end", pa.int64()), ("readings", _READINGS)])
)


_FIELDS = [field.name for field in _READINGS.value_type]


def _candidates(text: str):
    for match in CANDIDATE.finditer(text):
        readings = []
        for name, spelled, part in encodings(match[0]):
            own = (name, len(spelled), *statistics(spelled, name, part))
            readings.append(dict(zip(_FIELDS, own, strict=True)))
        if readings:
            yield {"start": match.start(), "end": match.end(), "readings": readings}


def text_model(pairs: np.ndarray) -> dict[str, tuple[float, float, float, float, float]]:
    """For each encoding, what ordinary text gives, and the change of kinds in even draws.

    Text is told by its surplus of chi-squared, that surplus's spread, how often the kind of symbol
    changes and the serial correlation.

    ``pairs`` counts neighbouring symbols. Text is restricted to the alphabet, every pair a
    little more than it was met, so that an alphabet that text never uses is still possible.
    For alphabets of capitals all text counts as if in capitals, as text rarely has words in them.
    """
    out = {}
    upper = np.arange(65)
    upper[26:52] = np.arange(26)
    capitals = np.zeros_like(pairs)
    np.add.at(capitals, (upper[:, None], upper[None, :]), pairs)
    for name, alphabet in ALPHABETS.items():
        fold = alphabet == alphabet.upper()
        places = [_SYMBOLS.index(c) for c in alphabet]
        own = (capitals if fold else pairs)[np.ix_(places, places)].astype(float) + 0.01
        own /= own.sum()
        share = own.sum(1)
        size = len(alphabet)
        surplus = size * float((share**2).sum()) - 1  # of chi-squared, for each symbol
        cubic = size**2 * float((share**3).sum()) - (surplus + 1) ** 2
        kinds = _kinds(alphabet)
        change = float(own[kinds[:, None] != kinds[None, :]].sum())
        middle = np.arange(size) - (size - 1) / 2
        serial = float(middle @ own @ middle / (share @ middle**2))
        evenly = 1 - float((np.bincount(kinds) / size) @ (np.bincount(kinds) / size))
        out[name] = (surplus, max(cubic, 0.0), change, serial, evenly)
    return out


def _log_normal(value: Column, mean: Column, variance: Column) -> Column:
    return -(value - mean) * (value - mean) / (2 * variance) - F.log(variance) / 2


def evidence(token: Column, model: dict) -> Column:
    """Logarithm of the e-value of a token, from its best reading that is not rejected."""

    def of_reading(reading: Column) -> Column:
        log_e, least = _reading_evidence(reading, model)
        return F.when(least >= REJECT, log_e).otherwise(F.lit(NOTHING))

    best = F.array_max(F.transform(token["readings"], of_reading))
    return best - F.log(F.size(token["readings"]).cast("double"))


def _reading_evidence(token: Column, model: dict) -> tuple[Column, Column]:
    """Logarithm of the e-value of a reading, and the battery's least p-value for randomness."""
    length = token["length"].cast("double")
    # A candidate has a digit and a letter, so text without separators changes its kind once at least.
    forced = (token["neighbours"] == token["length"] - 1).cast("double")
    met = F.greatest(token["neighbours"].cast("double"), F.lit(1.0))

    def of(pick) -> Column:
        out = F.lit(0.0)
        for name, values in model.items():
            own = F.lit(float(pick(len(ALPHABETS[name]), values)))
            out = F.when(token["encoding"] == name, own).otherwise(out)
        return out

    size = of(lambda k, _: k)
    surplus, cubic = of(lambda _, v: v[0]), of(lambda _, v: v[1])
    change, serial = of(lambda _, v: v[2]), of(lambda _, v: v[3])
    fair = of(lambda _, v: v[4])
    chi, runs, rho = token["chi"], token["runs"], token["serial"]
    even = (
        (chi, size - 1, 2 * (size - 1) * (1 - 1 / length)),
        (runs, met * fair, met * fair * (1 - fair)),
        (rho, -met / (length * length), met / (length * length)),
    )
    text = (
        (
            chi,
            size - 1 + (length - 1) * surplus,
            2 * (size - 1) * (1 - 1 / length) + 4 * (length - 1) * (surplus + cubic),
        ),
        (
            runs,
            forced + (met - forced) * change,
            met * change * (1 - change) + met * met * SPREAD**2,
        ),
        (rho, serial * met / length, met / (length * length)),
    )
    log_e = F.lit(0.0)
    least = F.lit(1.0)
    for (value, mean, variance), (_, text_mean, text_variance) in zip(even, text, strict=True):
        log_e = log_e + _log_normal(value, mean, variance) - _log_normal(
            value, text_mean, text_variance
        )
        score = F.abs(value - mean) / F.sqrt(variance)
        least = F.least(least, F.exp(-score * score / 2))  # no less than the two-sided tail
    return log_e, least


def threshold(evidences: DataFrame, rate: float = RATE) -> float:
    """e-BH over all candidates from counts by evidence, in steps of a tenth: least log e-value.

    The counts are one row per step, so the driver's share does not grow with the candidates.
    Rounding evidence down keeps the rate.
    """
    step = F.floor(F.greatest(F.least(F.col("log_e"), F.lit(500.0)), F.lit(-500.0)) * 10)
    counts = evidences.groupBy(step.cast("int").alias("step")).count().collect()
    total = sum(row["count"] for row in counts)
    least, above = math.inf, 0
    for row in sorted(counts, key=lambda row: -row["step"]):
        above += row["count"]
        if row["step"] / 10 >= math.log(total / (rate * above)):
            least = row["step"] / 10
    return least


def find_secrets(docs: DataFrame, text: str = "text", rate: float = RATE) -> DataFrame:
    """One row per document: doc_id and ``spans``, an array of (start, kind, end) in order.

    Kinds are places in ``KINDS``; starts and ends are code points, ends exclusive. Base spans are
    always there; a random token is added if no base span covers it. Null and empty texts have no
    span. Repeated rows give repeated results, and each of their tokens is one candidate. An empty
    table gives no rows.
    """
    scanned = settle(scan(docs, text), "secret_scan")
    table = scanned.where("pair is not null").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    pairs = np.zeros(65 * 65)
    for row in table:  # one row per pair of symbols at most
        pairs[row["pair"]] = row["n"]
    model = text_model(pairs.reshape(65, 65))
    documents = scanned.where("pair is null")
    tokens = documents.select(F.explode("tokens").alias("token"))
    needed = threshold(tokens.select(evidence(F.col("token"), model).alias("log_e")), rate)

    def random_span(token: Column) -> Column:
        return F.struct(token["start"].alias("start"), F.lit(3).alias("kind"), token["end"].alias("end"))

    def told(token: Column) -> Column:
        return evidence(token, model) >= needed

    chosen = F.filter("tokens", told)
    fresh = F.filter(
        chosen,
        lambda t: ~F.exists("base", lambda b: (b["start"] <= t["start"]) & (b["end"] >= t["end"])),
    )
    spans = F.array_sort(F.concat(F.col("base"), F.transform(fresh, random_span)))
    return documents.select("doc_id", spans.alias("spans"))
