"""Personal data: exact patterns, and a linear-chain conditional random field over word shapes.

The patterns give the base spans. The field labels every white-space separated token of every whole
text from its shape, its neighbours' shapes and cue words, and adds spans the patterns do not cover
(keys and passwords, numbers written without a country code, account numbers).
It is trained by maximum likelihood on a small labelled table and decoded by Viterbi in numpy batches.

Words of letters and sentence marks alone are "other" where no token of another kind stands within
three places; the field decides all the rest. Decoding is exact but skips what cannot matter: where
"other" beats every label by more than the two transitions around a token can ever make up, the best
path passes through "other", and the chain falls apart into short independent pieces.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import TEXT, free_name, rows_of, ships_by_value, text_bytes

# Kinds of the base patterns in listed order (fixed values), then those of the field alone.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("secret", "account")
LABELS = ("other",) + KINDS
SPANS = rows_of(kind=TEXT, begin=T.IntegerType(), end=T.IntegerType(), base=T.BooleanType())

# --- base patterns -------------------------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is entered at its first digit only: a match never begins inside one.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for at, d in enumerate(reversed(digits)):
        n = int(d)
        if at % 2:
            n = 2 * n - 9 if n > 4 else 2 * n
        total += n
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            done = domain.end()
            yield begin, done
        else:
            done = max(done, at + 1)  # no later match can reach over an @
        at = text.find("@", at + 1)


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of the base patterns, sorted."""
    found = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-9:]) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


# --- word shapes -----------------------------------------------------------------------------------

# Character classes of bytes; each class is one bit of a token's pattern.
_CLASSES = (" \t\n\r\x0b\x0c", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789",
            "@", ".", "-", "_", "+", "()", ":/", "=", "\"'`", ",;!?")
_SPACE, _DIGIT = 0, 3
_REST, _HIGH = len(_CLASSES), len(_CLASSES) + 1
_CLASS_OF = np.full(256, _REST, np.uint8)
for _n, _chars in enumerate(_CLASSES):
    _CLASS_OF[np.frombuffer(_chars.encode(), np.uint8)] = _n
_CLASS_OF[128:] = _HIGH
_BIT_OF = (1 << _CLASS_OF.astype(np.int64)).astype(np.uint16)
# Tokens of these classes alone are ordinary words.
_ORDINARY = sum(1 << c for c in (1, 2, 6, 9, 12, 13, 5, _REST, _HIGH))
# Cue words of the training table, by lower-cased letters.
CUES = ("phone", "tel", "call", "mobile", "fax", "password", "key", "secret", "token", "api", "iban",
        "account", "ssn", "card", "ip", "host", "mail", "email", "version", "license", "page", "year")
_LENGTHS = np.array([1, 2, 3, 4, 6, 9, 13, 17, 21, 29])
_COUNTS = np.array([1, 2, 3, 4, 5, 8, 10, 13, 16, 20])
# Sizes of a token's features, in order: pattern, length x digits, ends, changes x digit share,
# dots x dashes.
_SLOTS = (1024, 121, 256, 44, 20)
_BASES = np.concatenate(([0], np.cumsum(_SLOTS)))
_OWN = int(_BASES[-1])
_WIDTH = 3 * _OWN + 3 * (len(CUES) + 1) + 1  # itself, the one before, the one after; cues; bias


@dataclass
class Tokens:
    """Tokens of a run of bytes: bounds and features (rows of slot numbers)."""

    begin: np.ndarray
    end: np.ndarray
    pattern: np.ndarray


def tokenise(run: bytes) -> tuple[Tokens, np.ndarray]:
    codes = np.frombuffer(run, np.uint8)
    classes = _CLASS_OF[codes]
    edges = np.flatnonzero(np.diff(np.concatenate(([0], (classes != _SPACE).view(np.int8), [0]))))
    begin, end = edges[::2], edges[1::2]
    if not len(begin):
        return Tokens(begin, end, np.zeros(0, np.uint16)), classes
    bits = _BIT_OF[codes]
    # Spaces between tokens only add the space bit, which is taken off.
    pattern = np.bitwise_or.reduceat(bits, begin) & np.uint16(0xFFFE)
    return Tokens(begin, end, pattern), classes


def shape_features(classes: np.ndarray, begin: np.ndarray, end: np.ndarray,
                   pattern: np.ndarray) -> np.ndarray:
    """Five slot numbers for each of the given tokens."""
    if not len(begin):
        return np.zeros((0, len(_SLOTS)), np.int64)
    length = end - begin
    starts = np.concatenate(([0], np.cumsum(length)[:-1]))
    inside = classes[np.repeat(begin - starts, length) + np.arange(int(length.sum()))]
    digits = np.add.reduceat((inside == _DIGIT).astype(np.int64), starts)
    dots = np.add.reduceat((inside == 5).astype(np.int64), starts)
    dashes = np.add.reduceat(((inside == 6) | (inside == 10)).astype(np.int64), starts)
    change = np.concatenate((inside[1:] != inside[:-1], [False])).astype(np.int64)
    change[starts[1:] - 1] = 0
    changes = np.add.reduceat(change, starts)
    bucket = lambda values, cuts: np.searchsorted(cuts, values, side="right")
    mixed = (pattern.astype(np.int64) * 40503 >> 3) % _SLOTS[0]
    return np.stack([
        mixed,
        bucket(length, _LENGTHS) * 11 + bucket(digits, _COUNTS),
        classes[begin].astype(np.int64) * 16 + classes[end - 1],
        np.minimum(changes, 10) * 4 + np.minimum(3, 4 * digits // length),
        np.minimum(dots, 4) * 4 + np.minimum(dashes, 3)], axis=1) + _BASES[:-1]


def cue_of(token: bytes) -> int:
    word = re.sub(rb"[^a-z]", b"", token.lower()).decode()
    return CUES.index(word) + 1 if word in CUES else 0


# --- the field -------------------------------------------------------------------------------------

@dataclass
class Field:
    """Weights by feature and label, and transition scores."""

    weights: np.ndarray
    moves: np.ndarray

    def own(self, features: np.ndarray, place: int) -> np.ndarray:
        """Scores of tokens' shapes, seen as itself (0), as the one before (1) or after (2)."""
        return self.weights[features + place * _OWN].sum(axis=1)

    def cue(self, cues: np.ndarray, place: int) -> np.ndarray:
        return self.weights[3 * _OWN + place * (len(CUES) + 1) + cues]


def _columns(features: np.ndarray, cues: np.ndarray, lengths: list[int]) -> np.ndarray:
    """Feature numbers of each token of a training set, -1 where a neighbour is missing."""
    n, k = features.shape
    out = np.full((n, 3 * k + 3 + 1), -1, np.int64)
    out[:, :k], out[:, 3 * k], out[:, -1] = features, 3 * _OWN + cues, _WIDTH - 1
    at = 0
    for length in lengths:
        for i in range(at, at + length):
            for place, j in ((1, i - 1), (2, i + 1)):
                if at <= j < at + length:
                    out[i, place * k:(place + 1) * k] = features[j] + place * _OWN
                    out[i, 3 * k + place] = 3 * _OWN + place * (len(CUES) + 1) + cues[j]
        at += length
    return out


def train_field(table: list[list[tuple[str, str]]], rounds: int = 150, rate: float = 0.15,
                decay: float = 2e-3) -> Field:
    """Maximum likelihood (with weight decay) by full-batch Adam; scaled forward and backward passes."""
    lengths = [len(row) for row in table]
    words = [w.encode() for row in table for w, _ in row]
    tokens, classes = tokenise(b" ".join(words))
    features = shape_features(classes, tokens.begin, tokens.end, tokens.pattern)
    columns = _columns(features, np.array([cue_of(w) for w in words]), lengths) % (_WIDTH + 1)
    gold = np.array([LABELS.index(label) for row in table for _, label in row])
    n, k, longest = len(table), len(LABELS), max(lengths)
    place = np.zeros((n, longest), np.int64)
    mask = np.arange(longest) < np.array(lengths)[:, None]
    place[mask] = np.arange(len(words))
    same = mask[:, 1:]
    weights, moves = np.zeros((_WIDTH + 1, k)), np.zeros((k, k))
    seen = [(np.zeros_like(weights), np.zeros_like(weights)), (np.zeros_like(moves), np.zeros_like(moves))]

    def by_feature(shares: np.ndarray) -> np.ndarray:
        return np.stack([np.bincount(columns.ravel(), np.repeat(shares[:, label], columns.shape[1]), _WIDTH + 1)
                         for label in range(k)], axis=1)

    wanted = by_feature(np.eye(k)[gold])
    wanted_moves = np.zeros_like(moves)
    np.add.at(wanted_moves, (gold[place[:, :-1][same]], gold[place[:, 1:][same]]), 1.0)
    for step in range(1, rounds + 1):
        score = weights[columns].sum(axis=1)[place]
        score = np.exp(score - score.max(axis=2, keepdims=True))
        move = np.exp(moves)
        ahead, back = np.zeros((n, longest, k)), np.ones((n, longest, k))
        ahead[:, 0] = score[:, 0] / score[:, 0].sum(axis=1, keepdims=True)
        for t in range(1, longest):
            new = ahead[:, t - 1] @ move * score[:, t]
            ahead[:, t] = new / new.sum(axis=1, keepdims=True)
        for t in range(longest - 2, -1, -1):
            new = (back[:, t + 1] * score[:, t + 1]) @ move.T
            back[:, t] = np.where(mask[:, t + 1, None], new / new.sum(axis=1, keepdims=True), 1.0)
        share = ahead * back
        share /= share.sum(axis=2, keepdims=True)
        pair = ahead[:, :-1, :, None] * move * (score * back)[:, 1:, None, :]
        pair /= pair.sum(axis=(2, 3), keepdims=True)
        grads = (wanted - by_feature(share[mask]) - decay * len(words) * weights,
                 wanted_moves - pair[same].sum(axis=0) - decay * len(words) * moves)
        for values, grad, (m, v) in zip((weights, moves), grads, seen):
            grad = grad / n
            m += 0.1 * (grad - m)
            v += 0.01 * (grad ** 2 - v)
            values += rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        weights[-1] = 0.0  # the place of missing neighbours
    return Field(weights[:-1].astype(np.float32), moves.astype(np.float32))


# Patterns of the labelled table: {kind count} or {kind least-most} stands for random characters, d digits,
# l small letters, u capitals and digits, m letters of both cases, h hexadecimal digits; | separates choices.
_LABELLED = {
    "email": ("{l2-9}.{d2}@{l2-8}.example.com", "{l3-12}@{l3-9}.{l2-3}", "{l2-6}{d1-3}@{l3-9}.{l2-3}"),
    "ip": ("{d1-2}.{d1-2}.{d1-2}.{d1-2}", "1{d2}.{d1-2}.1{d2}.{d1-2}", "{d2}.1{d2}.{d2}.1{d2}"),
    "card": ("4{d15}", "{d4} {d4} {d4} {d4}", "{d4}-{d4}-{d4}-{d4}"),
    "phone": ("+{d1-2} ({d3}) {d3}-{d4}", "({d3}) {d3}-{d4}", "{d3}-{d3}-{d4}", "+{d1-2} {d3} {d3} {d4}"),
    "secret": ("AKIA{u16}", "sk-{m20-36}", "ghp_{m20-36}", "xoxb-{m20-36}", "password={h10-20}",
               "secret={h10-20}", "token={h10-20}", "pwd={h10-20}", "key={h10-20}"),
    "account": ("{u2}{d18-22}", "{d3}-{d2}-{d4}"),
}
# Cue words before a labelled token.
_AFTER_CUE = (
    ("phone", ("call", "tel", "phone:", "mobile"), "{d3} {d3} {d4}"),
    ("secret", ("api_key =", "token =", "secret :", "key =", "token :"), '"{h16-40}"'),
    ("secret", ("key:", "token:", "password:", "secret:"), "{m12-32}"),
)
# What is no personal data though it has digits or marks.
_PLAIN = (
    "{d1-4}", "{d1}.{d1}", "{d1}.{d1}.", "{d1-2}%", "{d1-3},{d3}", "v{d1}.{d1-2}", "19{d2}", "20{d2}",
    "({d1-2})", "#{d1-4}", "{l1-4}{d1-2}", "{d2}:{d2}", "20{d2}-{d2}-{d2}", "{d1-2}/{d1-2}/20{d2}",
    "{l2-8}-{d1-2}", "{d6-9}", "${d1-5}", "{d1-2}x{d1-2}", "{l2-9}***", "{l2-9}###", "{l2-9}&&&",
    "{l2-9}%%%", "{l2-9}$$$", "{l2-9}.***", '"{l2-9}"', "({l2-9})", "{l2-6}/{l2-6}", "--", "=", "-", "/",
    "{l1-6}={l1-6}", "https://{l3-9}.example/{l2-7}", "@{l3-9}", "{l3-8}_{l3-8}", "+{d1-2}",
)
_SETS = {"d": "0123456789", "l": "abcdefghijklmnopqrstuvwxyz", "u": "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
         "m": "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", "h": "0123456789abcdef"}


def labelled_table(rows: int = 900, seed: int = 7) -> list[list[tuple[str, str]]]:
    """The small labelled table: rows of tokens made from the patterns, among ordinary words."""
    rng = random.Random(seed)

    def fill(pattern: str) -> str:
        return re.sub(r"\{(\w)(\d+)(?:-(\d+))?\}", lambda m: "".join(
            rng.choice(_SETS[m[1]]) for _ in range(rng.randint(int(m[2]), int(m[3] or m[2])))), pattern)

    def labelled() -> list[tuple[str, str]]:
        if rng.random() < 0.2:
            label, cues, pattern = rng.choice(_AFTER_CUE)
            row = [(t, "other") for t in rng.choice(cues).split()]
        else:
            label, row = rng.choice(list(_LABELLED)), []
            pattern = rng.choice(_LABELLED[label])
        tokens = fill(pattern).split()
        tokens[-1] += rng.choice(["", "", "", ".", ","])
        return row + [(t, label) for t in tokens]

    def words(most: int, plain: float = 0.0) -> list[tuple[str, str]]:
        row = []
        for _ in range(rng.randint(0, most)):
            word = fill("{l1-11}") + rng.choice(["", "", "", "ä", "éñ"])
            word = rng.choice([word] * 6 + [word.capitalize(), word + ".", word + ","])
            row.append((fill(rng.choice(_PLAIN)) if rng.random() < plain else word, "other"))
        return row

    table = []
    for _ in range(rows):
        row = words(5)
        for _ in range(rng.randint(0, 2)):
            row += labelled() + words(4, 0.4)
        table.append(row + [(fill("{l2-9}"), "other")] + words(4, 0.6))
    return table


@lru_cache(maxsize=1)
def trained_field() -> Field:
    return train_field(labelled_table())


def decode(model: Field, scores: np.ndarray, pieces: list[tuple[int, int]]) -> np.ndarray:
    """Best labels of independent pieces (begin, end) of tokens, each with "other" on both sides.

    Viterbi over all pieces at once, longest first; each time step is one numpy operation.
    """
    labels = np.zeros(len(scores), np.int8)
    if not pieces:
        return labels
    bounds = np.array(sorted(pieces, key=lambda p: p[0] - p[1]))
    begin, length = bounds[:, 0], bounds[:, 1] - bounds[:, 0]
    best = scores[begin] + model.moves[0]
    came = []
    for t in range(1, int(length[0])):
        active = int(np.searchsorted(-length, -t, side="left"))  # pieces longer than t
        step = best[:active, :, None] + model.moves
        came.append(step.argmax(axis=1).astype(np.int8))
        new = step.max(axis=1) + scores[begin[:active] + t]
        best[:active] = new
    last = (best + model.moves[:, 0]).argmax(axis=1)
    for t in range(int(length[0]) - 1, -1, -1):
        active = int(np.searchsorted(-length, -t, side="left"))
        labels[begin[:active] + t] = last[:active]
        if t:
            last[:active] = np.take_along_axis(came[t - 1], last[:active, None].astype(np.int64), 1)[:, 0]
    return labels


def label_tokens(model: Field, run: bytes, bounds: np.ndarray) -> tuple[Tokens, np.ndarray]:
    """Tokens of a run of texts and the best label of each; chains do not cross the texts' bounds."""
    tokens, classes = tokenise(run)
    n = len(tokens.begin)
    labels = np.zeros(n, np.int8)
    if not n:
        return tokens, labels
    text_no = np.searchsorted(bounds, tokens.begin, side="right")
    odd = (tokens.pattern & np.uint16(0xFFFF ^ _ORDINARY)) != 0
    close = odd.copy()
    for shift in (1, 2, 3):
        close[shift:] |= odd[:-shift]
        close[:-shift] |= odd[shift:]
    at = np.flatnonzero(close)
    if not len(at):
        return tokens, labels
    features = shape_features(classes, tokens.begin[at], tokens.end[at], tokens.pattern[at])
    cues = np.fromiter((cue_of(run[a:b]) for a, b in zip(tokens.begin[at].tolist(), tokens.end[at].tolist())),
                       np.int64, len(at))
    scores = model.own(features, 0) + model.cue(cues, 0) + model.weights[-1]
    follows = (np.diff(at) == 1) & (text_no[at][1:] == text_no[at][:-1])
    before, after = model.own(features, 1) + model.cue(cues, 1), model.own(features, 2) + model.cue(cues, 2)
    scores[1:][follows] += before[:-1][follows]
    scores[:-1][follows] += after[1:][follows]
    # Certain: "other" leads by more than both transitions can make up.
    spread = 2 * float(model.moves.max() - model.moves.min())
    certain = scores[:, 0] - scores[:, 1:].max(axis=1) > spread
    joined = np.concatenate(([False], follows & ~certain[1:] & ~certain[:-1], [False]))
    open_at = np.flatnonzero(~certain)
    heads = open_at[~joined[open_at]]
    tails = open_at[~joined[open_at + 1]] + 1
    labels[at] = decode(model, scores, list(zip(heads.tolist(), tails.tolist())))
    return tokens, labels


_TRIM = b".,;:!?()[]{}<>\"'`|"


def plausible(kind: int, found: bytes) -> bool:
    """What the field adds must hold up as its kind: enough digits, a checksum, a full address."""
    digits = re.sub(rb"[^0-9]", b"", found).decode()
    if KINDS[kind] == "email":
        return re.fullmatch(rb"[^@\s]+@[^@\s]+\.[^@\s]+", found) is not None
    if KINDS[kind] == "ip":
        parts = found.split(b".")
        return len(parts) == 4 and all(p.isdigit() and int(p[-9:]) <= 255 for p in parts)
    if KINDS[kind] == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if KINDS[kind] == "phone":
        return 7 <= len(digits) <= 15
    return len(found) >= 9


def field_spans(run: bytes, tokens: Tokens, labels: np.ndarray, lo: int, hi: int) -> list[tuple[int, int, int]]:
    """(begin byte, kind number, end byte) of labelled stretches among the tokens lo .. hi."""
    found = []
    at = lo
    while at < hi:
        label = labels[at]
        end = at + 1
        if label:
            while end < hi and labels[end] == label:
                end += 1
            a, b = int(tokens.begin[at]), int(tokens.end[end - 1])
            keep = b"(" if LABELS[label] == "phone" else b""
            piece = run[a:b]
            inner = piece.lstrip(_TRIM.replace(keep, b"") if keep else _TRIM)
            a += len(piece) - len(inner)
            b = a + len(inner.rstrip(_TRIM))
            if plausible(int(label) - 1, run[a:b]):
                found.append((a, int(label) - 1, b))
        at = end
    return found


# Texts are worked on in parts of about so many bytes, which bounds the arrays.
PART_BYTES = 1 << 21


def spans_of(model: Field, pieces: list[bytes]) -> list[list[dict]]:
    """Spans of each text, base patterns and field together, by start."""
    # One line feed after each text, so that no token crosses texts.
    run = b"\n".join(pieces)
    starts = np.cumsum([0, *[len(p) + 1 for p in pieces[:-1]]])
    tokens, labels = label_tokens(model, run, starts)
    first = np.searchsorted(tokens.begin, starts)
    last = np.append(first[1:], len(tokens.begin))
    marked = np.concatenate(([0], np.cumsum(labels != 0)))
    codes = np.frombuffer(run, np.uint8)
    special = np.concatenate(([0], np.cumsum(((codes >= 48) & (codes <= 57)) | (codes == 64), dtype=np.int32)))
    out = []
    for piece, start, lo, hi in zip(pieces, starts.tolist(), first.tolist(), last.tolist()):
        if special[start] == special[start + len(piece)] and marked[lo] == marked[hi]:
            out.append([])
            continue
        text = piece.decode(errors="replace")
        base = base_spans(text)
        every = [(a, k, b, True) for a, k, b in base]
        reach = []  # the furthest end among the base spans so far
        for _, _, b in base:
            reach.append(max(b, reach[-1] if reach else 0))
        at, point = start, 0
        for a, k, b in field_spans(run, tokens, labels, lo, hi):
            begin = point + len(run[at:a].decode(errors="replace"))
            end = begin + len(run[a:b].decode(errors="replace"))
            at, point = b, end
            earlier = bisect_left(base, (end,))  # base spans that begin before the end
            if not earlier or reach[earlier - 1] <= begin:
                every.append((begin, k, end, False))
        out.append([{"kind": KINDS[k], "begin": a, "end": b, "base": is_base}
                    for a, k, b, is_base in sorted(every)])
    return out


def spans_udf(model: Field):
    @F.arrow_udf(SPANS)
    def spans(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct([("kind", pa.string()), ("begin", pa.int32()), ("end", pa.int32()),
                          ("base", pa.bool_())])
        for column in texts:
            yield pa.array(column_spans(model, column), pa.list_(kind))
    return spans


def column_spans(model: Field, column: pa.Array) -> list[list[dict]]:
    run, bounds = text_bytes(column)
    out, part, held = [], [], 0
    for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
        if part and held + b - a > PART_BYTES:
            out += spans_of(model, part)
            part, held = [], 0
        part.append(bytes(run[a:b]))
        held += b - a
    if part:
        out += spans_of(model, part)
    return out


def find_personal_data(docs: DataFrame, text: str = "text", into: str = "pii") -> DataFrame:
    """``docs`` with the column ``into``: spans (kind, begin, end in code points, base) by start.

    Every row comes back once. Null and empty texts have no spans. A span of the field that overlaps a
    base span is left out. A column of ``docs`` named ``into`` is replaced.
    """
    return docs.withColumn(into, spans_udf(trained_field())(F.col(text)))


def mask_personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets, overlapping ones by the first's.

    Texts without spans, null texts among them, stay as they are.
    """
    masked = free_name(docs, "masked")
    found = docs.withColumn(masked, mask_udf(trained_field())(F.col(text)))
    return found.withColumn(text, F.coalesce(F.col(masked), F.col(text))).drop(masked)


def mask_udf(model: Field):
    @F.arrow_udf(TEXT)
    def masked(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        """The masked text where there is something to mask, else null."""
        for column in texts:
            yield pa.array(column_masked(model, column), pa.string())
    return masked


def column_masked(model: Field, column: pa.Array) -> list[str | None]:
    run, bounds = text_bytes(column)
    return [mask_text(bytes(run[a:b]).decode(errors="replace"), spans) if spans else None
            for a, b, spans in zip(bounds, bounds[1:], column_spans(model, column))]


def mask_text(text: str, spans: list[dict]) -> str:
    pieces, at = [], 0
    for span in spans:
        if span["begin"] >= at:
            pieces += [text[at:span["begin"]], f"[{span['kind'].upper()}]"]
        at = max(at, span["end"])
    return "".join(pieces) + text[at:]


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))), ",")


ships_by_value(__name__)
