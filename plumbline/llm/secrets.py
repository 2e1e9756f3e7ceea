"""Secrets: exact patterns, and a character convolutional network over candidates in their context.

The patterns give the base spans. Candidates are all runs of eight or more of the characters keys are made
of that hold a digit, change from small to capital letters, or are assigned with ``:`` or ``=``. Each is
seen as 24 bytes before it, its first 40 bytes and 8 bytes after it. The network (embedding, one
convolution, pooling before, inside and after, one layer) is trained in numpy on labelled findings; its
scores are calibrated on findings kept apart, where the threshold of assigned and of bare candidates is the
highest that still finds the wanted share. Workers only run it, in numpy batches.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import DOUBLE, TEXT, rows_of, ships_by_value, text_bytes

# Kinds of the base patterns in listed order (fixed values), then the network's.
BASE_KINDS = ("assign", "access", "hex")
LEARNED = "learned"
KINDS = BASE_KINDS + (LEARNED,)
SPANS = rows_of(kind=TEXT, begin=T.IntegerType(), end=T.IntegerType(), base=T.BooleanType(), score=DOUBLE)

_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
LEAST_ASSIGNED, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

# --- candidates ------------------------------------------------------------------------------------

LEAST_LENGTH = 8
BEFORE, INSIDE, AFTER = 24, 40, 8
WIDTH = BEFORE + INSIDE + AFTER
_SEGMENTS = (slice(0, BEFORE), slice(BEFORE, BEFORE + INSIDE), slice(BEFORE + INSIDE, WIDTH))
_LENGTHS = np.array([12, 16, 24, 32, 48])
_IN = np.zeros(256, bool)
_IN[np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.-", np.uint8)] = True
_IS_DIGIT, _IS_LOWER, _IS_UPPER, _IS_HEX = (
    np.isin(np.arange(256), np.frombuffer(chars, np.uint8))
    for chars in (b"0123456789", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789abcdef"))
_SKIPPED = np.isin(np.arange(256), np.frombuffer(b" \"'", np.uint8))
_ASSIGNS = np.isin(np.arange(256), np.frombuffer(b":=", np.uint8))
# Characters of the network: 0 is nothing, 1 to 95 printable ASCII, 96 a line's end or tab, 97 any other.
_CODE_OF = np.full(256, 97, np.uint8)
_CODE_OF[32:127] = np.arange(1, 96)
_CODE_OF[9:14] = 96
N_CODES = 98


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).view(np.int8)))
    return edges[::2], edges[1::2]


def is_assigned(codes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Whether ``:`` or ``=`` stands before, with at most three spaces or quotes between."""
    found, open_ = np.zeros(len(begin), bool), np.ones(len(begin), bool)
    for back in range(1, 5):
        at = begin - back
        byte = np.where(at >= 0, codes[np.maximum(at, 0)], 0) if len(codes) else np.zeros(len(begin), np.uint8)
        found |= open_ & _ASSIGNS[byte]
        open_ &= _SKIPPED[byte]
    return found


def candidates(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and whether it is assigned, of every candidate in a run of bytes."""
    begin, end = _runs(_IN[codes])
    long = end - begin >= LEAST_LENGTH
    begin, end = begin[long], end[long]
    if not len(begin):
        return begin, end, np.zeros(0, bool)
    # Sentence marks at the end do not belong to it.
    for _ in range(3):
        end = end - (codes[end - 1] == ord("."))
    keep = end - begin >= LEAST_LENGTH
    begin, end = begin[keep], end[keep]
    if not len(begin):
        return begin, end, np.zeros(0, bool)
    length = end - begin
    starts = np.concatenate(([0], np.cumsum(length)[:-1]))
    inside = codes[np.repeat(begin - starts, length) + np.arange(int(length.sum()))]
    rises = _IS_LOWER[inside]
    rises[:-1] &= _IS_UPPER[inside[1:]]
    rises[starts[1:] - 1] = False
    rises[-1] = False
    odd = np.logical_or.reduceat(_IS_DIGIT[inside] | rises, starts)
    assigned = is_assigned(codes, begin)
    keep = odd | assigned
    begin, end, assigned = begin[keep], end[keep], assigned[keep]
    padding = np.append(codes, [0, 0]).astype(np.uint8)
    for _ in range(2):
        end = end + (padding[end] == ord("="))
    return begin, end, assigned


def views(codes: np.ndarray, begin: np.ndarray, end: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """What the network sees of each candidate; nothing from beyond its text's bounds lo and hi."""
    at = np.concatenate([begin[:, None] + np.arange(-BEFORE, INSIDE), end[:, None] + np.arange(AFTER)], axis=1)
    seen = (at >= lo[:, None]) & (at < hi[:, None])
    seen[:, _SEGMENTS[1]] &= at[:, _SEGMENTS[1]] < end[:, None]
    return np.where(seen, _CODE_OF[codes[np.clip(at, 0, len(codes) - 1)]], 0)


# --- the network -----------------------------------------------------------------------------------

EMBEDDED, TAPS, FILTERS = 8, 5, 24
_POOLED = 4 * FILTERS + len(_LENGTHS) + 1


@dataclass
class Detector:
    """Weights; slope and offset of the calibration; thresholds of bare and of assigned candidates."""

    embed: np.ndarray
    kernel: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    calibration: tuple[float, float] = (1.0, 0.0)
    thresholds: tuple[float, float] = (0.5, 0.5)

    def weights(self) -> list[np.ndarray]:
        return [self.embed, self.kernel, self.bias, self.out]

    def forward(self, view: np.ndarray, length: np.ndarray) -> dict:
        n = len(view)
        inner = view[:, _SEGMENTS[1]] > 0
        marked = np.zeros((n, WIDTH + TAPS - 1, EMBEDDED + 1), np.float32)
        half = TAPS // 2
        marked[:, half:-half, :-1] = self.embed[view]
        marked[:, half + BEFORE:half + BEFORE + INSIDE, -1] = inner
        columns = np.concatenate([marked[:, t:t + WIDTH] for t in range(TAPS)], axis=2)
        act = np.maximum(columns.reshape(-1, TAPS * (EMBEDDED + 1)) @ self.kernel + self.bias, 0)
        act = act.reshape(n, WIDTH, FILTERS)
        act[:, _SEGMENTS[1]] *= inner[:, :, None]
        best = [act[:, s].argmax(axis=1) + s.start for s in _SEGMENTS]
        shown = np.maximum(inner.sum(axis=1), 1)[:, None].astype(np.float32)
        pooled = np.zeros((n, _POOLED), np.float32)
        for k, at in enumerate(best):
            pooled[:, k * FILTERS:(k + 1) * FILTERS] = np.take_along_axis(act, at[:, None], 1)[:, 0]
        pooled[:, 3 * FILTERS:4 * FILTERS] = act[:, _SEGMENTS[1]].sum(axis=1) / shown
        pooled[np.arange(n), 4 * FILTERS + np.searchsorted(_LENGTHS, length, side="right")] = 1
        return {"columns": columns, "act": act, "best": best, "shown": shown, "pooled": pooled, "inner": inner,
                "logit": pooled @ self.out}

    def gradients(self, view: np.ndarray, length: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
        """Of the mean log loss, in the order of ``weights``."""
        f = self.forward(view, length)
        n = len(view)
        wrong = (1 / (1 + np.exp(-f["logit"])) - label).astype(np.float32) / n
        back = wrong[:, None] * self.out
        act = np.zeros_like(f["act"])
        rows, filters = np.arange(n)[:, None], np.arange(FILTERS)
        for k, at in enumerate(f["best"]):
            act[rows, at, filters] += back[:, k * FILTERS:(k + 1) * FILTERS]
        act[:, _SEGMENTS[1]] += (back[:, 3 * FILTERS:4 * FILTERS] / f["shown"])[:, None] * f["inner"][:, :, None]
        act = (act * (f["act"] > 0)).reshape(-1, FILTERS)
        columns = (act @ self.kernel.T).reshape(n, WIDTH, TAPS, EMBEDDED + 1)
        marked = np.zeros((n, WIDTH + TAPS - 1, EMBEDDED), np.float32)
        for t in range(TAPS):
            marked[:, t:t + WIDTH] += columns[:, :, t, :-1]
        marked = marked[:, TAPS // 2:TAPS // 2 + WIDTH].reshape(-1, EMBEDDED)
        embed = np.stack([np.bincount(view.ravel(), marked[:, d], N_CODES) for d in range(EMBEDDED)], axis=1)
        return [embed.astype(np.float32), f["columns"].reshape(-1, TAPS * (EMBEDDED + 1)).T @ act,
                act.sum(axis=0), f["pooled"].T @ wrong]

    def scores(self, view: np.ndarray, length: np.ndarray, step: int = 1024) -> np.ndarray:
        """Calibrated probabilities, a bounded number of candidates at a time."""
        slope, offset = self.calibration
        logits = [self.forward(view[i:i + step], length[i:i + step])["logit"] for i in range(0, len(view), step)]
        return 1 / (1 + np.exp(-(slope * np.concatenate([np.zeros(0), *logits]) + offset)))


@dataclass(frozen=True)
class Finding:
    """A labelled candidate: the text before, itself, the text after, and whether it is a secret."""

    before: str
    found: str
    after: str
    secret: bool
    family: str = ""


def findings_views(findings: Sequence[Finding]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What the network sees of labelled findings, their lengths, and which are assigned."""
    runs = [(f.before.encode(), f.found.encode(), f.after.encode()) for f in findings]
    codes = np.frombuffer(b"".join(b"".join(r) for r in runs) + b" ", np.uint8)
    sizes = np.array([[len(p) for p in r] for r in runs], np.int64).reshape(-1, 3)
    hi = np.cumsum(sizes.sum(axis=1))
    lo = hi - sizes.sum(axis=1)
    begin = lo + sizes[:, 0]
    end = begin + sizes[:, 1]
    assigned = np.array([bool(is_assigned(np.frombuffer(a or b"\n", np.uint8), np.array([len(a)]))[0])
                         for a, _, _ in runs], bool)
    return views(codes, begin, end, lo, hi), end - begin, assigned


# The share of the findings kept apart that the thresholds must find.
LEAST_RECALL = 0.97
KEPT_APART = 0.3


def train_detector(findings: Sequence[Finding], epochs: int = 10, batch: int = 128, rate: float = 5e-3,
                   least_recall: float = LEAST_RECALL, seed: int = 3) -> Detector:
    """Adam on the log loss of a part of the findings; calibration and thresholds from the rest."""
    rng = np.random.default_rng(seed)
    view, length, assigned = findings_views(findings)
    label = np.array([f.secret for f in findings], np.float32)
    apart = rng.random(len(findings)) < KEPT_APART
    normal = lambda *shape: rng.normal(0, shape[0] ** -0.5, shape).astype(np.float32)
    model = Detector(rng.normal(0, 0.5, (N_CODES, EMBEDDED)).astype(np.float32),
                     normal(TAPS * (EMBEDDED + 1), FILTERS), np.zeros(FILTERS, np.float32),
                     np.zeros(_POOLED, np.float32))
    seen = [(np.zeros_like(w), np.zeros_like(w)) for w in model.weights()]
    rows, step = np.flatnonzero(~apart), 0
    for _ in range(epochs):
        rng.shuffle(rows)
        for i in range(0, len(rows), batch):
            at, step = rows[i:i + batch], step + 1
            for w, g, (m, v) in zip(model.weights(), model.gradients(view[at], length[at], label[at]), seen):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9 ** step) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8) + 1e-3 * w)
    return calibrate(model, view[apart], length[apart], assigned[apart], label[apart], least_recall)


def calibrate(model: Detector, view: np.ndarray, length: np.ndarray, assigned: np.ndarray, label: np.ndarray,
              least_recall: float) -> Detector:
    """Slope and offset by Newton steps on smoothed labels; then the highest thresholds of enough recall."""
    logit = model.forward(view, length)["logit"].astype(float) if len(view) else np.zeros(0)
    yes = label.sum()
    wanted = np.where(label > 0, (yes + 1) / (yes + 2), 1 / (len(label) - yes + 2))
    x = np.stack([logit, np.ones_like(logit)], axis=1)
    at = np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        at = at + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2),
                                  x.T @ (wanted - p) - 1e-3 * (at - [1.0, 0.0]))
    model.calibration = (float(at[0]), float(at[1]))
    score = model.scores(view, length)
    thresholds = []
    for group in (~assigned, assigned):
        held = np.sort(score[group & (label > 0)])
        thresholds.append(float(held[int((1 - least_recall) * len(held))]) if len(held) else 0.5)
    model.thresholds = (thresholds[0], thresholds[1])
    return model


# --- labelled findings -----------------------------------------------------------------------------

# {kind count} or {kind least-most} stands for random characters: d digits, l small letters, u capitals and
# digits, m letters and digits, h hexadecimal digits, b base64, w a word; a line is before^found^after.
_SECRET = {
    "assigned hex": ("{k} = \"^{h20-64}^\"", "{k}={q}^{h16-48}^{q}", "\"{k}\": \"^{h24-40}^\",", "{k}: ^{h20-40}^"),
    "assigned mixed": ("{k} = '^{m16-44}^'", "{k}=^{m12-40}^", "\"{k}\": \"^{m16-48}^\"}}", "{k} : ^{m14-32}^",
                       "export {K}=^{m20-40}^", "--{k} ^{m16-40}^"),
    "assigned base64": ("{k}: ^{b24-64}^", "{k} = \"^{b32-80}=^\"", "{K}=\"^{b28-60}==^\""),
    "pass phrase": ("{k}=^{w}{d2-4}_{w}^", "{k}: ^{w}-{d2}{w}{d2}^", "{k} = \"^{m4-6}.{m6-10}^\""),
    "forge": ("{s}^ghp_{m36}^", "{s}^gho_{m36}^", "{s}^github_pat_{m22}_{m40-59}^", "{s}^glpat-{m20}^"),
    "model key": ("{s}^sk-{m32-48}^", "{s}^hf_{m34}^", "{s}^sk-proj-{m40-56}^"),
    "payment": ("{s}^sk_live_{m24}^", "{s}^rk_live_{m24}^", "{s}^pk_live_{m24}^"),
    "chat": ("{s}^xoxb-{d11-12}-{d11-12}-{m24}^", "{s}^xoxp-{d11}-{m20-30}^"),
    "cloud": ("{s}^AKIA{u16}^", "{s}^ASIA{u16}^", "{s}^AIza{m35}^", "{s}^ya29.{m40-70}^"),
    "web token": ("{s}^eyJ{b20-36}.eyJ{b40-80}.{b30-43}^", "Bearer ^{b40-90}^", "Authorization: Basic ^{b24-40}=^"),
    "mail key": ("{s}^SG.{m22}.{m43}^", "{s}^key-{h32}^"),
    "bare": ("{s}^{h32}^", "{s}^{h40}^", "{s}^{h64}^", "{s}^{b40-64}=^", "{s}^{m32-48}^"),
    "address": ("postgres://{w}:^{m12-24}^@{w}.example", "https://{w}:^{m10-20}^@{w}.example.com/"),
}
_PLAIN = {
    "word": ("{s}^{w}{w}{d1-3}^", "{s}^{w}{w}{W}^", "{s}^{w}-{w}-{d1-2}^", "{s}^{W}{W}{W}^"),
    "name": ("{s}^{w}_{w}_{d1-2}^", "def ^{w}_{w}2{w}^(", "{s}^get{W}{W}^(", "class ^{W}{W}{d1}^:"),
    "number": ("{s}^{d8-19}^", "{s}^{d4}-{d4}-{d4}-{d4}^", "+{d1} ({d3}) ^{d3}-{d4}^", "{s}^{d3}-{d3}-{d4}^",
               "{s}^{d1-3}.{d3}.{d3}^", "{s}^{d3}.{d2}.{d2}.{d3}^", "tel: ^{d3}-{d3}-{d4}^", "isbn: ^97{d1}-{d10}^"),
    "time": ("{s}^20{d2}-{d2}-{d2}^", "{s}^20{d2}-{d2}-{d2}T{d2}^:{d2}:{d2}Z", "date: ^{d2}.{d2}.20{d2}^",
             "{s}^20{d6}^", "at: ^20{d12}^"),
    "version": ("{s}^v{d1}.{d1-2}.{d1-2}-rc{d1}^", "version = \"^{d1}.{d2}.{d1}-beta{d1}^\"", "{w}==^{d1}.{d1}.{d1}.post{d1}^"),
    "path": ("{s}^/{w}/{w}/{w}{d1-2}.txt^", "https:^//{w}.example.com/{w}/{d3-6}^", "path: ^./{w}/{w}.py^",
             "file = \"^{w}/{w}-{d2}.csv^\"", "href=\"^/{w}/{w}.html^\""),
    "mail": ("{w}.{d2}@^{w}{d1}.example.com^", "{s}^{w}.{w}{d2}^@{w}.example.com", "mail: ^{w}.{w}^@example.org"),
    "identifier": ("{s}^{h8}-{h4}-4{h3}-a{h3}-{h12}^", "id: ^{h8}-{h4}-4{h3}-b{h3}-{h12}^", "commit ^{h8-10}^",
                   "color: #^{h8}^", "{s}^{u2}-{d6-8}^", "order = ^{u3}{d6-9}^"),
    "assigned plain": ("{w}={q}^{w}{w}^{q}", "{w}: ^{w}{w}^", "{w} = \"^{w}-{w}^\"", "{w}: ^{W}{w}^", "width=^{d4}.{d4}^",
                       "size: ^{d8-11}^", "class=\"^{w}-{w}{d1}^\""),
    "placeholder": ("{k}=^your_{k}_here^", "{k}: ^xxxxxxxxxxxx^", "{k} = \"^example-{w}^\"", "{k}=^process.env.{K}^",
                    "{k}: ^changeme^", "{k} = ^os.environ.get^(", "{k}: ^required^", "{k} = ^get_{w}_{w}^()"),
}
_SETS = {"d": "0123456789", "l": "abcdefghijklmnopqrstuvwxyz", "u": "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
         "h": "0123456789abcdef"}
_SETS["m"] = _SETS["l"] + _SETS["u"]
_SETS["b"] = _SETS["m"] + "-_"
_KEYS = ("password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "access_token", "client_secret",
         "auth", "private_key", "secret_key", "db_password")
_CUES = ("", "", "", "", "key ", "the ", "use ", "and ", "de ", "with ", "(", "`", "- ", "| ", "\"", "of. ", "###")
FAMILIES = tuple(_SECRET) + tuple(_PLAIN)


def labelled_findings(rows: int = 4000, seed: int = 11, families: Sequence[str] = FAMILIES) -> list[Finding]:
    """Labelled findings made by rule, half of them secrets, among invented words."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("bcdfghlmnprstvwz") + rng.choice(
        ("a", "e", "i", "o", "u", "en", "er", "st", "th", "on")) for _ in range(rng.randint(1, 4)))

    def fill(pattern: str, key: str, quote: str) -> str:
        def one(m: re.Match) -> str:
            kind = m[1]
            if kind == "k":
                return key
            if kind == "K":
                return key.upper()
            if kind == "q":
                return quote
            if kind == "s":
                return rng.choice(_CUES)
            if kind in "wW":
                return word().capitalize() if kind == "W" else word()
            n = rng.randint(int(m[2]), int(m[3] or m[2]))
            return "".join(rng.choice(_SETS[kind]) for _ in range(n))
        return re.sub(r"\{(\w)(?:(\d+)(?:-(\d+))?)?\}", one, pattern)

    secret, plain = ([f for f in group if f in families] for group in (_SECRET, _PLAIN))
    found = []
    for _ in range(rows):
        is_secret = rng.random() < 0.5
        family = rng.choice(secret if is_secret else plain)
        key = rng.choice(_KEYS)
        if rng.random() < 0.3:
            key = rng.choice((key.upper(), key.replace("_", "-"), f"{word()}_{key}"))
        before, middle, after = fill(rng.choice((_SECRET if is_secret else _PLAIN)[family]), key,
                                     rng.choice(("", "\"", "'"))).split("^")
        if len(middle) < LEAST_LENGTH:
            middle += fill("{l4}{d4}", key, "")
        lead = "".join(word() + rng.choice((" ", " ", ", ", ". ", "\n", "é ")) for _ in range(rng.randint(0, 6)))
        tail = rng.choice(("", "", ".", ",", "\n")) + "".join(f" {word()}" for _ in range(rng.randint(0, 3)))
        found.append(Finding(lead + before, middle, after + tail, is_secret, family))
    return found


@lru_cache(maxsize=1)
def trained_detector() -> Detector:
    return train_detector(labelled_findings())


# --- spans -----------------------------------------------------------------------------------------

# Texts are worked on in parts of about so many bytes, which bounds the arrays.
PART_BYTES = 1 << 21


def base_matches(run: bytes, codes: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(begin, kind number, end, where the secret itself begins) in bytes; no match crosses a line feed."""
    found = [(m.start(), 0, m.end(), m.start(2)) for m in _ASSIGN.finditer(run)
             if m.end(2) - m.start(2) >= LEAST_ASSIGNED]
    found += [(m.start(), 1, m.end(), m.start()) for m in _ACCESS.finditer(run)
              if m.end() - m.start() >= LEAST_ACCESS]
    begin, end = _runs(_IS_HEX[codes])
    long = end - begin >= LEAST_HEX
    found += [(a, 2, b, a) for a, b in zip(begin[long].tolist(), end[long].tolist())]
    return sorted(found)


def spans_of(model: Detector, pieces: list[bytes]) -> list[list[dict]]:
    """Spans of each text, base patterns and network together, by start."""
    run = b"\n".join(pieces)
    codes = np.frombuffer(run, np.uint8)
    lo = np.cumsum([0, *[len(p) + 1 for p in pieces[:-1]]])
    hi = lo + np.array([len(p) for p in pieces])
    base = base_matches(run, codes)
    begin, end, assigned = candidates(codes)
    at = np.concatenate([begin, np.array([b[3] for b in base], np.int64)])
    until = np.concatenate([end, np.array([b[2] for b in base], np.int64)])
    out: list[list[dict]] = [[] for _ in pieces]
    if not len(at):
        return out
    text_no = np.searchsorted(lo, at, side="right") - 1
    view = views(codes, at, until, lo[text_no], hi[text_no])
    score = model.scores(view, until - at)
    # The furthest end among base spans that begin before a place.
    base_begin = np.array([b[0] for b in base], np.int64)
    reach = np.maximum.accumulate(np.array([b[2] for b in base], np.int64)) if base else base_begin
    n = len(begin)
    earlier = np.searchsorted(base_begin, end)
    covered = np.zeros(n, bool)
    if base:
        covered = (earlier > 0) & (reach[np.maximum(earlier - 1, 0)] > begin)
    picked = ~covered & (score[:n] >= np.where(assigned, model.thresholds[1], model.thresholds[0]))
    every = [(int(begin[i]), len(BASE_KINDS), int(end[i]), float(score[i])) for i in np.flatnonzero(picked)]
    every += [(a, k, b, float(s)) for (a, k, b, _), s in zip(base, score[n:])]
    every.sort()
    # Code points before a byte of its text: bytes that do not continue one.
    text, done, points = -1, 0, 0
    for a, k, b, s in every:
        no = int(np.searchsorted(lo, a, side="right")) - 1
        if no != text:
            text, done, points = no, int(lo[no]), 0
        points += _points(codes, done, a)
        done = a
        out[no].append({"kind": KINDS[k], "begin": points, "end": points + _points(codes, a, b),
                        "base": k < len(BASE_KINDS), "score": s})
    return out


def _points(codes: np.ndarray, a: int, b: int) -> int:
    return int(((codes[a:b] & 0xC0) != 0x80).sum())


def column_spans(model: Detector, column: pa.Array) -> list[list[dict]]:
    run, bounds = text_bytes(column)
    out, part, held = [], [], 0
    for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
        if part and held + b - a > PART_BYTES:
            out += spans_of(model, part)
            part, held = [], 0
        part.append(bytes(run[a:b]))
        held += b - a
    return out + (spans_of(model, part) if part else [])


def spans_udf(model: Detector):
    kind = pa.struct([("kind", pa.string()), ("begin", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()),
                      ("score", pa.float64())])

    @F.arrow_udf(SPANS)
    def spans(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            yield pa.array(column_spans(model, column), pa.list_(kind))
    return spans


def find_secrets(docs: DataFrame, text: str = "text", into: str = "secrets",
                 model: Detector | None = None) -> DataFrame:
    """``docs`` with the column ``into``: spans (kind, begin, end in code points, base, score) by start.

    Every row comes back once. Null and empty texts have no spans. A span of the network that overlaps a
    base span is left out. ``score`` is the network's, also where a base pattern decided. A column of
    ``docs`` named ``into`` is replaced. ``model`` is one trained on the caller's own findings.
    """
    return docs.withColumn(into, spans_udf(model or trained_detector())(F.col(text)))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))), ",")


ships_by_value(__name__)
