"""Personal data by weak supervision.

Base spans follow fixed rules: e-mail addresses, IPv4 addresses, payment cards and phone numbers. Beyond them every other
token with a digit, and every address written with ``(at)`` or ``[at]``, is a candidate. Labelers vote on it: patterns,
gazetteers of cue words, and rules over its context; each may abstain. Expectation-maximisation over all candidates of
the corpus estimates how reliable each labeler is and how likely a candidate is personal data given its votes. These
probabilities train the final span classifier, a logistic regression over votes and shape features, which decides.

What the first pass gathers is one count for each (votes, shape) pattern: all candidates count, and there are at most
``3 ** 7 * 2 ** 6`` patterns (about 140,000; some hundreds occur), so the driver's part is bounded whatever the corpus.

Cases: a null or empty text has no spans; repeated documents are judged each on its own; a corpus without candidates
trains nothing and adds nothing; long digit runs are scanned in linear time.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.text import map_texts, pick, slices

BASE_KINDS = ("email", "ip", "card", "phone")
#: Kinds that only the labelers find: other contacts, identity numbers, access keys, secrets.
ADDED_KINDS = ("contact", "identity", "key", "secret")
Span = tuple[int, int]

_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WRITTEN_AT = re.compile(r"[\[(] ?at ?[\])]")
_EDGE = frozenset("\"'`<>()[]{},;=:|")
_CUES_SECRET = frozenset("password passwd pwd passwort contraseña token secret apikey api_key access_key bearer auth".split())
_CUES_CONTACT = frozenset("call tel phone mobile fax contact whatsapp telefon téléphone teléfono".split())
_CUES_IDENTITY = frozenset("ssn iban passport bsn nif dni social taxid".split())
_CUES_PUBLIC = frozenset("version v license licensed section chapter page figure fig table year isbn by-nc by-sa by".split())
_ACCESS_KEY = re.compile(r"(?=[A-Z]*[0-9])(?=[0-9]*[A-Z])[A-Z0-9]{16,40}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_NUMBER = re.compile(r"\+?[0-9]+(?:[.,:/-][0-9]+)*[.,]?")
_SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}")
_LOCAL_PHONE = re.compile(r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}")
_WORD_BEFORE = re.compile(r"[^\W\d_][\w-]*")

LABELERS = 7
SHAPES = 6


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base_spans(text: str) -> dict[str, list[Span]]:
    """The spans of the fixed rules, leftmost and non-overlapping within each kind."""
    found: dict[str, list[Span]] = {kind: [] for kind in BASE_KINDS}
    if "@" in text:
        floor = 0
        for m in _AT.finditer(text):
            start = m.start()
            while start > floor and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                found["email"].append((start, m.end()))
                floor = m.end()
    if _DIGIT.search(text) is None:
        return found
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            found["ip"].append(m.span())
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                found["card"].append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                found["phone"].append(m.span())
    return found


def _entropy(token: str) -> float:
    return -sum(n / len(token) * math.log2(n / len(token)) for n in Counter(token).values())


def _iban_ok(token: str) -> bool:
    moved = token[4:] + token[:4]
    return _IBAN.fullmatch(token) is not None and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _judge(text: str, start: int, end: int) -> tuple[str, int]:
    """The likely kind of a candidate and its pattern: the votes in base 3 (0 abstains, 1 for, 2 against), the shape."""
    token = text[start:end]
    head = token[:200]
    before = text[max(0, start - 40) : start]
    words = [w.lower() for w in _WORD_BEFORE.findall(before)[-3:]]
    assigned = before.rstrip("\"' ").endswith(("=", ":"))
    digits = sum("0" <= c <= "9" for c in head)
    letters = sum(c.isalpha() for c in head)
    number = _NUMBER.fullmatch(head) is not None
    key = _ACCESS_KEY.fullmatch(head) is not None
    hexed = _HEX.fullmatch(head) is not None
    ssn = _SSN.fullmatch(head) is not None
    iban = _iban_ok(head)
    phone = _LOCAL_PHONE.fullmatch(head) is not None
    written = _WRITTEN_AT.search(head) is not None
    near_secret = any(w in _CUES_SECRET for w in words)
    near_contact = any(w in _CUES_CONTACT for w in words)
    near_identity = any(w in _CUES_IDENTITY for w in words)
    public = any(w in _CUES_PUBLIC for w in words)
    mixed = digits >= 3 and letters >= 3 and len(head) >= 12 and _entropy(head) >= 3.0
    votes = (
        1 if key or iban or phone or written else 2 if number and digits <= 6 and not ssn else 0,  # patterns
        1 if near_secret or near_contact or near_identity else 0,  # gazetteer of cue words
        2 if public else 0,  # gazetteer of public contexts
        1 if assigned and len(head) >= 8 else 2 if number and not assigned else 0,  # assignment context
        1 if mixed else 2 if len(head) < 8 else 0,  # randomness of the characters
        1 if hexed else 0,  # hexadecimal text
        1 if ssn or iban else 2 if number and digits < 8 else 0,  # checks of identity numbers
    )
    shape = (len(head) >= 16, digits * 2 >= len(head), letters * 2 >= len(head), head.isupper(), near_secret, assigned)
    kind = (
        "contact"
        if written or phone or near_contact
        else "identity"
        if ssn or iban or near_identity or (number and digits >= 12)
        else "key"
        if key
        else "secret"
    )
    code = 0
    for vote in votes:
        code = code * 3 + vote
    for bit in shape:
        code = code * 2 + bit
    return kind, code


def candidates(text: str, base: dict[str, list[Span]]) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, pattern) of every candidate that touches no base span, by start."""
    taken = sorted(span for spans in base.values() for span in spans)
    out: list[tuple[str, int, int, int]] = []
    done, nth = 0, 0

    def offer(start: int, end: int) -> None:
        nonlocal nth
        while nth < len(taken) and taken[nth][1] <= start:
            nth += 1
        if not any(s < end and start < e for s, e in taken[nth : nth + 4]):
            kind, code = _judge(text, start, end)
            out.append((kind, start, end, code))

    at = 0
    while (m := _DIGIT.search(text, at)) is not None:
        start = m.start()
        local = _LOCAL_PHONE.match(text, start - 1 if start > done and text[start - 1] == "(" else start)
        if local is not None:
            start, end = local.span()
        else:
            while start > done and not text[start - 1].isspace() and text[start - 1] not in _EDGE:
                start -= 1
            end = m.end()
            while end < len(text) and not text[end].isspace() and text[end] not in _EDGE:
                end += 1
            while end > m.end() and text[end - 1] in ".!?":
                end -= 1
        offer(start, end)
        at = done = max(end, m.end())
    nth = 0
    for m in _WRITTEN_AT.finditer(text):
        start, end = m.start(), m.end()
        start -= start > 0 and text[start - 1] == " "
        while start > 0 and text[start - 1] in _LOCAL:
            start -= 1
        end += end < len(text) and text[end] == " "
        while end < len(text) and text[end] in _LOCAL:
            end += 1
        if start < m.start() and end > m.end() and not any(s < end and start < e for _, s, e, _ in out):
            offer(start, end)
    return sorted(out, key=lambda c: c[1:3])


def _votes(codes: np.ndarray) -> np.ndarray:
    rest = codes >> SHAPES
    return np.stack([rest // 3**i % 3 for i in range(LABELERS - 1, -1, -1)], 1)


def _features(codes: np.ndarray) -> np.ndarray:
    votes = _votes(codes)
    shape = np.stack([codes >> i & 1 for i in range(SHAPES - 1, -1, -1)], 1)
    return np.hstack([votes == 1, votes == 2, shape, np.ones((len(codes), 1))]).astype(float)


def reliabilities(codes: np.ndarray, counts: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """P(personal | votes) of each pattern, and P(vote | class) of each labeler, by expectation-maximisation.

    It starts from the majority, and a prior worth a few votes says that labelers are mostly right.
    """
    votes = _votes(codes)
    margin = (votes == 1).sum(1) - (votes == 2).sum(1)
    posterior = 1 / (1 + np.exp(-2.0 * margin + 0.5))
    prior_votes = np.array([[6.0, 1.0, 3.0], [6.0, 3.0, 1.0]])  # not personal, personal: abstains, for, against
    prior_votes[0, 1], prior_votes[0, 2] = 1.0, 3.0
    for _ in range(rounds):
        table = np.tile(prior_votes, (LABELERS, 1, 1))
        for value in range(3):
            cast = votes == value
            table[:, 0, value] += (cast * ((1 - posterior) * counts)[:, None]).sum(0)
            table[:, 1, value] += (cast * (posterior * counts)[:, None]).sum(0)
        table /= table.sum(2, keepdims=True)
        share = ((posterior * counts).sum() + 1) / (counts.sum() + 2)
        odds = np.full(len(codes), math.log(share / (1 - share)))
        for i in range(LABELERS):
            odds += np.log(table[i, 1, votes[:, i]] / table[i, 0, votes[:, i]])
        posterior = 1 / (1 + np.exp(-odds))
    return posterior, table


def train(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Weights of the span classifier: logistic regression on the probabilities from the labelers, by Newton's method."""
    if not len(codes):
        return np.zeros(2 * LABELERS + SHAPES + 1)
    target, _ = reliabilities(codes, counts)
    x, w = _features(codes), np.log1p(counts)
    weights = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ weights))
        slope = x.T @ (w * (target - p)) - 0.1 * weights
        curve = (x * (w * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(weights))
        weights += np.linalg.solve(curve, slope)
    return weights


def accepted_patterns(docs: DataFrame, text: str = "text") -> frozenset[int]:
    """The patterns that the classifier, trained on all candidates of the corpus, takes for personal data."""
    schema = T.StructType([T.StructField("code", T.LongType()), T.StructField("n", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[int] = Counter()
        for batch in batches:
            for part in slices(batch, text):
                for value in part.column(0).to_pylist():
                    if value:
                        found.update(c[3] for c in candidates(value, base_spans(value)))
        columns = [pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["code", "n"])

    counted = pick(docs, text).mapInArrow(count, schema).groupBy("code").agg(F.sum("n").alias("n"))
    rows = counted.orderBy("code").collect()
    codes, counts = np.array([r.code for r in rows], np.int64), np.array([r.n for r in rows], float)
    if not len(codes):
        return frozenset()
    return frozenset(codes[_features(codes) @ train(codes, counts) > 0].tolist())


def all_spans(text: str, accepted: frozenset[int]) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """The base spans and the added ones, by kind."""
    base = base_spans(text)
    added: dict[str, list[Span]] = {kind: [] for kind in ADDED_KINDS}
    for kind, start, end, code in candidates(text, base):
        if code in accepted:
            added[kind].append((start, end))
    return base, added


def _joined(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, found in spans.items() for start, end in found)


RESULT = T.StructType(
    [T.StructField(f"n_{kind}", T.LongType()) for kind in BASE_KINDS]
    + [
        T.StructField("base_sha256", T.StringType()),
        T.StructField("spans", T.StringType()),
        T.StructField("n_added", T.LongType()),
    ]
)


def find_personal_data(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """For each document its ``keep`` columns, the counts and digest of the base spans, and all spans."""
    accepted = docs.sparkSession.sparkContext.broadcast(accepted_patterns(docs, text))

    def make():
        def compute(part: pa.RecordBatch) -> list[pa.Array]:
            rows = []
            for value in part.column(part.schema.get_field_index(text)).to_pylist():
                base, added = all_spans(value or "", accepted.value)
                first, more = _joined(base), _joined(added)
                digest = hashlib.sha256(first.encode()).hexdigest()
                spans = ",".join(x for x in (first, more) if x)
                rows.append((*map(len, base.values()), digest, spans, sum(map(len, added.values()))))
            types = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int64()]
            return [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]

        return compute

    return map_texts(docs, text, RESULT, make, keep)


def redact(text: str, accepted: frozenset[int]) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans become the first one's kind."""
    base, added = all_spans(text, accepted)
    spans = sorted((s, e, kind) for found in (base, added) for kind, own in found.items() for s, e in own)
    out, done = [], 0
    for start, end, kind in spans:
        if start >= done:
            out += [text[done:start], f"<{kind.upper()}>"]
        done = max(done, end)
    return "".join([*out, text[done:]])
