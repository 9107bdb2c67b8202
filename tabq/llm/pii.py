"""Personal data: exact patterns, and a skip-chain conditional random field that adds to them.

The patterns give base spans, which always stay. The field then labels the tokens that could be
personal data (those with a digit or an at sign; all others are O with certainty). A token's own
potentials come from its shape and its neighbours; next to each other tokens share transition
potentials; tokens anywhere in the text that repeat each other, wholly or in their last digits, share
skip potentials, also those of numbers that blanks cut into groups. Tokens of base spans are observed. Loopy belief propagation runs over all texts of a
batch at once; a token that is not in a base span becomes one of its own if its marginal for a label
reaches `SURE`. So a number that is written once as a clear phone number is found where it is
written in another way.

Weights are fitted to base labels on tokens of a bounded sample of texts; repeated occurrences are
linked to one of them, so edges grow with the tokens, not with their pairs.

Defined results: NULL and empty texts have no spans. Equal rows get equal results, one each; an empty
table gives no rows; without any training token only base spans are given. Whole texts are read. New
columns replace those of the same name in the input.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabq.llm.common import append, column_texts, slices

KINDS = ("email", "ip", "card", "phone")
LABELS = len(KINDS) + 1  # the last is O
OTHER = len(KINDS)
FEATURES = 1 << 12
SAMPLE_DOCS = 5_000  # texts that weights are fitted on, at most
SAMPLE_TOKENS = 40_000  # and tokens of those
SETTLED = 1e-4  # message passing goes on until no message changes by more
ROUNDS = 400  # or, where loops keep it from settling, so many times
SURE = 0.95
LAST_DIGITS = 7

# The same matches as the patterns of the contract, without their repeated attempts in long runs.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*")
_NOT_DIGITS = re.compile(r"[^0-9]+")
_PLAIN_IP = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = 2 * n - 9 * (n > 4)
        total += n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start."""
    found, before = [], 0
    if "@" in text:
        for m in _DOMAIN.finditer(text):
            start = m.start()
            while start > before and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                found.append((0, start, m.end()))
                before = m.end()
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255
                   for p in m.group().split(".")):
                found.append((1, *m.span()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = _NOT_DIGITS.sub("", m.group())
                if 13 <= len(digits) <= 19 and luhn(digits):
                    found.append((2, *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_NOT_DIGITS.sub("", m.group())) <= 15:
                    found.append((3, *m.span()))
    return found


def shape(token: str) -> str:
    """Digits as 9, letters as a; runs of letters as one."""
    return re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]", "9", token))[:40]


@dataclass
class Tokens:
    """Candidate tokens of one text."""

    spans: list[tuple[int, int]]
    features: list[list[int]]
    labels: list[int]  # by the base spans
    keys: list[str | None]  # tokens with the same key repeat each other
    joined: list[bool]  # with the candidate before: only white space between


def tokens_of(text: str, base: list[tuple[int, int, int]]) -> Tokens:
    out = Tokens([], [], [], [], [])
    marks = sorted((s, e, k) for k, s, e in base)
    at, end_before, shape_before = 0, -1, ""
    digits, named = [], []  # of tokens without letters; is it an address
    for m in _TOKEN.finditer(text):
        start, end = m.span()
        word = m.group()
        while at < len(marks) and marks[at][1] <= start:
            at += 1
        label = OTHER
        for s, e, k in marks[at:at + 4]:
            if s < end and e > start:
                label = k
                break
        before = text[max(0, start - 40):start].split()
        joined = end_before >= 0 and not text[end_before:start].strip(" \t\n\x0b\x0c\r")
        own = shape(word.strip(".,;:!?\"'"))
        names = (f"s {own}", f"n {sum(c == '9' for c in own)}", f"@ {'@' in word}",
                 f"b {before[-1].lower().strip('.,;:') if before and not joined else ''}",
                 f"p {shape_before if joined else ''}", "1")
        out.spans.append((start, end))
        out.features.append([xxhash.xxh3_64_intdigest(n.encode()) % FEATURES for n in names])
        out.labels.append(label)
        bare = word.lower().strip(".,;:!?\"'()<>[]")
        named.append("@" in word or _PLAIN_IP.fullmatch(bare) is not None)
        out.keys.append(bare if named[-1] else None)
        digits.append(_NOT_DIGITS.sub("", word) if "a" not in own and not named[-1] else "")
        out.joined.append(joined)
        end_before, shape_before = end, own
    # numbers, also those that blanks group: the last digits of the whole, and the place from its end
    end = len(digits)
    while end:
        start = end - 1
        while start and out.joined[start] and digits[start] and digits[start - 1]:
            start -= 1
        whole = "".join(digits[max(start, end - LAST_DIGITS):end])[-LAST_DIGITS:]
        if len(whole) == LAST_DIGITS:
            for k in range(start, end):
                out.keys[k] = f"{whole} {end - k}"
        elif end - start == 1 and not named[start]:
            whole = _NOT_DIGITS.sub("", text[slice(*out.spans[start])])
            if len(whole) >= LAST_DIGITS:  # a number with letters around
                out.keys[start] = f"{whole[-LAST_DIGITS:]} 1"
        end = start
    return out


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # (FEATURES, LABELS)
    chain: np.ndarray  # (LABELS, LABELS) log potentials of neighbours
    skip: np.ndarray  # the same of repeated tokens


def edges_of(tokens: Tokens) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Chain and skip edges. Repeated tokens are linked to the first of them in a base span, or else to
    the first: a star, so that evidence reaches each of them at once."""
    chain = [(i - 1, i) for i in range(1, len(tokens.spans)) if tokens.joined[i]]
    hub: dict[str, int] = {}
    for i, key in enumerate(tokens.keys):
        if key is not None and (key not in hub or (
                tokens.labels[hub[key]] == OTHER and tokens.labels[i] != OTHER)):
            hub[key] = i
    return chain, [(hub[key], i) for i, key in enumerate(tokens.keys) if key is not None and hub[key] != i]


def _sampled(batches):
    """Per token: features, label, the label of its chain and of its skip partner."""
    for batch in (part for whole in batches for part in slices(whole)):
        rows = []
        for i, text in zip(batch.column("id").to_pylist(), column_texts(batch, "text")):
            tokens = tokens_of(text, base_spans(text))
            chain, skip = edges_of(tokens)
            partner = [dict((b, tokens.labels[a]) for a, b in e) for e in (chain, skip)]
            rows += [(i, k, tokens.features[k], tokens.labels[k], partner[0].get(k, -1),
                      partner[1].get(k, -1)) for k in range(len(tokens.spans))]
        columns = list(zip(*rows)) if rows else [[]] * 6
        kinds = [pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.int32(), pa.int32(), pa.int32()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            names=["id", "k", "features", "label", "before", "same"])


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
          sample_docs: int = SAMPLE_DOCS, sample_tokens: int = SAMPLE_TOKENS) -> Model:
    """Fit the field on tokens of the texts whose ids have the smallest hashes."""
    named = docs.select(F.xxhash64(doc_id).alias("id"), F.col(text).alias("text"))
    chosen = named.where(F.col("text").rlike("[0-9@]")).select("id").distinct().orderBy("id").limit(
        sample_docs)
    rows = named.join(F.broadcast(chosen), "id", "left_semi").mapInArrow(
        _sampled, "id long, k int, features array<int>, label int, before int, same int").orderBy(
        F.xxhash64("id", "k"), "id", "k", "features").limit(sample_tokens).collect()
    if not rows:
        empty = np.zeros((LABELS, LABELS))
        return Model(np.zeros((FEATURES, LABELS)), empty, empty)
    x = np.array([r.features for r in rows])
    y = np.array([r.label for r in rows])
    return Model(fit(x, y), _potentials([(r.before, r.label) for r in rows]),
                 _potentials([(r.same, r.label) for r in rows]))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.5,
        decay: float = 1e-4) -> np.ndarray:
    """Multinomial logistic regression over rows of feature numbers, adaptive gradient steps."""
    w, squares = np.zeros((FEATURES, LABELS)), np.full((FEATURES, LABELS), 1e-8)
    target = np.eye(LABELS)[y]
    for _ in range(rounds):
        error = np.exp(_normal(w[x].sum(1))) - target
        gradient = np.zeros_like(w)
        for j in range(x.shape[1]):
            for k in range(LABELS):
                gradient[:, k] += np.bincount(x[:, j], error[:, k], FEATURES)
        gradient = gradient / len(y) + decay * w
        squares += gradient ** 2
        w -= rate * gradient / np.sqrt(squares)
    return w


def _potentials(pairs: list[tuple[int, int]]) -> np.ndarray:
    """Log ratio of how often two labels meet to how often they would by chance."""
    n = np.full((LABELS, LABELS), 0.1) + np.eye(LABELS)
    for a, b in pairs:
        if a >= 0:
            n[a, b] += 1
            n[b, a] += 1
    n /= n.sum()
    return np.clip(np.log(n / n.sum(1)[:, None] / n.sum(0)[None]), -4, 4)


def _normal(x: np.ndarray) -> np.ndarray:
    x = x - x.max(-1, keepdims=True)
    return x - np.log(np.exp(x).sum(-1, keepdims=True))


def propagate(own: np.ndarray, edges: np.ndarray, pair: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Marginals of the nodes. own: log potentials; edges: (from, to); pair: log potentials of each.

    All messages of a round are sent together, damped by half, until they settle."""
    if len(edges) == 0:
        return np.exp(_normal(own))
    a, b = np.concatenate((edges, edges[:, ::-1])).T
    pair = np.concatenate((pair, pair.transpose(0, 2, 1)))
    back = np.concatenate((np.arange(len(edges)) + len(edges), np.arange(len(edges))))
    sent = np.zeros((len(a), LABELS))
    for _ in range(rounds):
        belief = own.copy()
        np.add.at(belief, b, sent)
        x = (belief[a] - sent[back])[:, :, None] + pair
        most = x.max(1)
        new = _normal(most + np.log(np.exp(x - most[:, None]).sum(1)))
        change = float(np.abs(new - sent).max())
        sent = 0.5 * sent + 0.5 * new
        if change < SETTLED:
            break
    belief = own.copy()
    np.add.at(belief, b, sent)
    return np.exp(_normal(belief))


def spans_of(texts: list[str], model: Model) -> list[tuple[list, list]]:
    """For each text its base spans and all spans, as (kind, start, end) by kind, then start."""
    base = [base_spans(t) for t in texts]
    tokens = [tokens_of(t, b) if _TOKEN.search(t) else None for t, b in zip(texts, base)]
    features, labels, edges, pairs, first = [], [], [], [], []
    for t in tokens:
        first.append(len(labels))
        if t is None:
            continue
        for found, potentials in zip(edges_of(t), (model.chain, model.skip)):
            edges += [(a + first[-1], b + first[-1]) for a, b in found]
            pairs += [potentials] * len(found)
        features += t.features
        labels += t.labels
    out = [(b, b) for b in base]
    if not labels or not model.weights.any():
        return out
    observed = np.array(labels)
    own = _normal(model.weights[np.array(features)].sum(1))
    seen = observed != OTHER
    own[seen] = -1e9  # certain, however many others it is linked to
    own[np.flatnonzero(seen), observed[seen]] = 0.0
    marginals = propagate(own, np.array(edges, np.int64).reshape(-1, 2),
                          np.array(pairs).reshape(-1, LABELS, LABELS))
    best = marginals[:, :OTHER].argmax(1)
    sure = (marginals[np.arange(len(best)), best] >= SURE) & ~seen
    for d, t in enumerate(tokens):
        if t is None:
            continue
        more, open_ = [], None
        for k, (start, end) in enumerate(t.spans):
            i = first[d] + k
            if not sure[i]:
                open_ = None
                continue
            word = texts[d][start:end]
            start += len(word) - len(word.lstrip(".,;:!?\"'<>[]"))
            end -= len(word) - len(word.rstrip(".,;:!?\"'<>[]"))
            if open_ is not None and t.joined[k] and open_[0] == best[i]:
                open_[2] = end
            else:
                open_ = [int(best[i]), start, end]
                more.append(open_)
        if more:
            out[d] = (base[d], sorted({*base[d], *map(tuple, more)}))
    return out


def written(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def find(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """df's columns `keep` (default: all), the number of base spans of each kind, a digest of the
    base spans and all spans as text."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def work(batch):
        rows = spans_of(column_texts(batch, text), shared.value)
        counts = [[sum(k == kind for k, _, _ in b) for b, _ in rows] for kind in range(len(KINDS))]
        return [*counts, [hashlib.sha256(written(b).encode()).hexdigest() for b, _ in rows],
                [written(s) for _, s in rows]]

    return append(df, work, ", ".join(f"n_{k} long" for k in KINDS)
                  + ", base_sha256 string, spans string", keep)


def redact(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """df with each span in its texts replaced by its kind; NULL stays NULL."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def work(batch):
        texts = batch.column(text).to_pylist()
        done = []
        for t, (_, spans) in zip(texts, spans_of([x or "" for x in texts], shared.value)):
            parts, at = [], 0
            for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
                if e > at:  # of overlapping spans the rest goes with the first
                    parts.append((t[at:s] + f"<{KINDS[kind].upper()}>") if s >= at else "")
                    at = e
            done.append(t if t is None or not spans else "".join(parts) + t[at:])
        return [done]

    return append(df, work, f"`{text}` string").select(df.columns)
