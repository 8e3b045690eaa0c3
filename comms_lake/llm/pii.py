"""Personal data: fixed patterns and a linear-chain conditional random field (operator 6).

The patterns (emails, IP addresses, card and telephone numbers) give the base
spans, which always stay. The field adds spans that the patterns miss, such as
telephone numbers without a country code. Its features are shapes of the
token, its two neighbours on either side, and whether white space stands
before it; its labels are begin and inside of each kind, and outside. It is
trained by numpy gradient ascent on the exact likelihood of a small labelled
table, and decodes lines by Viterbi in numpy batches. A found span is added if
it overlaps no base span and, spelled plainly, passes its kind's check: a card's
check digit behind any separators, an IPv4 address behind spaces or brackets or an
IPv6 address, 7 to 15 digits of a telephone number, an email with "at" and
"dot" for its signs. Names are no kind of its own.

Defined cases: null text counts as empty; empty texts have no spans; offsets
are code points, end exclusive; repeated rows give equal results; an empty
table gives an empty result; without labelled rows nothing is added. Texts of
any length are decoded whole: lines are the field's sequences, and long ones
only make a batch smaller.
"""

from __future__ import annotations

import ipaddress
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_texts
from .pii_rows import LABELLED

KINDS = ("email", "ip", "card", "phone")
LABELS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind
BATCH_TOKENS = 1 << 18

# The contract's patterns, written so that no text makes them slow: an email is
# looked for at its "@", a number only where a run of digits begins.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_HINT = re.compile(r"[0-9@]|(?<![A-Za-z])[Aa][Tt](?![A-Za-z])")  # what a span that the field may find must have


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def valid(kind: str, span: str) -> bool:
    digits = "".join(c for c in span if c in "0123456789")
    if kind == "ip":
        parts = span.split(".")
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and int(p[-4:] if p[:-4].strip("0") == "" else 999) <= 255
                                       for p in parts)
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    return True


_AT_SIGN = re.compile(r"\s*[\[({]?\s*(?:@|\bat\b)\s*[\])}]?\s*", re.I)
_DOT_SIGN = re.compile(r"\s*[\[({]\s*(?:\.|dot)\s*[\])}]\s*|\s+dot\s+|\s*\.\s*", re.I)
_ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")


def plausible(kind: str, span: str) -> bool:
    """Whether what the field found is of its kind once spelled plainly: spaces, brackets
    and words that stand for signs replaced, separators left out."""
    if kind == "email":
        return _ADDRESS.fullmatch(_DOT_SIGN.sub(".", _AT_SIGN.sub("@", span))) is not None
    if kind == "ip":
        if span.count(":") > 1:
            try:
                return bool(ipaddress.IPv6Address(span))
            except ValueError:
                return False
        return valid("ip", _DOT_SIGN.sub(".", span))
    digits = sum(c in "0123456789" for c in span)
    return 7 <= digits <= 15 if kind == "phone" else valid(kind, span)


def emails(text: str) -> Iterator[tuple[int, int]]:
    at, least = text.find("@"), 0
    while at >= 0:
        start = at
        while start > least and _LOCAL.match(text, start - 1):
            start -= 1
        end = at + 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            least = end = m.end()
        else:
            least = max(least, at + 1)  # a later address cannot begin before this sign
        at = text.find("@", end)


def base(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind as listed."""
    out = [(a, b, "email") for a, b in emails(text)]
    if _DIGITS.search(text):
        for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
            out += [(m.start(), m.end(), kind) for m in pattern.finditer(text) if valid(kind, m[0])]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


# --- tokens and shapes ---------------------------------------------------------------------------
_SPACE, _LETTER, _DIGIT, _MARK = range(4)
_CLASS = np.full(128, _MARK, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = _SPACE
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _LETTER
_DIGIT_BUCKET = np.array([0, 0, 1, 2, 3, 4, 4, 5, 5, 6, 6, 6, 7, 7, 7, 7, 8, 9, 9, 9, 10])
_LETTER_BUCKET = np.array([0, 0, 1, 2, 3, 3, 4])
_AT, _DOT = 15 + 11 + 96, 15 + 11 + 96 + 1  # the words that stand for "@" and "." have a shape of their own
SHAPES = 2 * (_DOT + 1) + 1  # letters by case and length, digits by length, marks, at, dot; glued or not; none


def tokens(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, shape, free) of each token of a line: a run of letters, a run
    of digits or a mark. ``free``: it can be in a span. Tokens of a piece
    between white space that has neither digit nor "@" are outside by rule, but
    for pieces of marks alone next to one that has, and for those around a word
    "at" that a piece with a "." or a word "dot" follows."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(code):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty.astype(bool)
    kind = np.where(code < 128, _CLASS[np.minimum(code, 127)], _LETTER)
    wide = np.flatnonzero(code >= 128)
    if len(wide):
        spaces = np.isin(code[wide], (0x85, 0xA0, 0x1680, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)) | (
            (code[wide] >= 0x2000) & (code[wide] <= 0x200A))
        kind[wide[spaces]] = _SPACE
    new = np.ones(len(code), bool)
    new[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _MARK)
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(code))
    solid = kind[start] != _SPACE
    glued = np.append(False, solid[:-1])[solid]
    start, end = start[solid], end[solid]
    if not len(start):
        return start, end, start, solid[:0]
    length, what, first = end - start, kind[start], code[start]
    upper = (first >= 65) & (first <= 90)
    second = code[np.minimum(start + 1, len(code) - 1)]
    case = np.where(~upper, 0, np.where((length > 1) & (second >= 65) & (second <= 90), 2, 1))
    shape = np.where(what == _LETTER, 5 * case + _LETTER_BUCKET[np.minimum(length, 6)],
                     np.where(what == _DIGIT, 15 + _DIGIT_BUCKET[np.minimum(length, 20)],
                              26 + np.clip(first.astype(np.int64) - 32, 0, 95)))
    low = lambda k: code[np.minimum(start + k, len(code) - 1)] | 32
    at = (what == _LETTER) & (length == 2) & (low(0) == 97) & (low(1) == 116)
    dot = (what == _LETTER) & (length == 3) & (low(0) == 100) & (low(1) == 111) & (low(2) == 116)
    shape = np.where(at, _AT, np.where(dot, _DOT, shape))
    piece = np.cumsum(~glued) - 1
    pieces = piece[-1] + 1
    live = np.bincount(piece, (what == _DIGIT) | (first == 64), pieces) > 0
    if at.any():  # "name at host dot org": the host's piece has a "." in it, or "dot" follows it
        within = np.append(glued[1:], False) & glued
        ended = np.bincount(piece, dot | (first == 46) & within, pieces + 5) > 0
        host = np.unique(piece[at])
        host = host[ended[host] | ended[host + 1] | ended[host + 2]]
        for step in range(-1, 6):
            live[(host + step)[(host + step >= 0) & (host + step < pieces)]] = True
    plain = np.bincount(piece, what == _LETTER, pieces) == 0
    near = np.zeros(pieces, bool)
    near[1:] |= live[:-1]
    near[:-1] |= live[1:]
    return start, end, 1 + 2 * shape + glued, (live | plain & near)[piece]


AROUND = (0, -1, 1, -2, 2)


def features(shape: np.ndarray) -> np.ndarray:
    """Per token of a line the shape numbers of itself and its neighbours (0: none)."""
    out = np.zeros((len(shape), len(AROUND)), np.int64)
    for k, step in enumerate(AROUND):
        i = np.arange(len(shape)) + step
        ok = (i >= 0) & (i < len(shape))
        out[ok, k] = shape[i[ok]]
    return out


# --- the field -----------------------------------------------------------------------------------
class Field:
    """Weights by (neighbour, shape, label) and by (label, next label); begin and end are outside."""

    def __init__(self):
        self.emit = np.zeros((len(AROUND), SHAPES, LABELS))
        self.pass_on = np.zeros((LABELS, LABELS))
        self.barred = np.zeros((LABELS, LABELS), bool)  # inside follows its own begin or inside only
        for k in range(len(KINDS)):
            inside = 2 + 2 * k
            self.barred[:, inside] = True
            self.barred[[inside - 1, inside], inside] = False

    def scores(self, found: np.ndarray) -> np.ndarray:
        return sum(self.emit[k][found[:, k]] for k in range(len(AROUND)))

    def moves(self) -> np.ndarray:
        return np.where(self.barred, -1e9, self.pass_on)

    def train(self, rows: list[tuple[np.ndarray, np.ndarray]], rounds: int = 250, rate: float = 0.3,
              decay: float = 2e-3) -> None:
        """Gradient ascent (Adagrad) on the likelihood of all rows, by forward and backward sums."""
        n, most = len(rows), max(len(y) for _, y in rows)
        found = np.zeros((n, most, len(AROUND)), np.int64)
        label = np.zeros((n, most), np.int64)
        on = np.zeros((n, most), bool)
        for r, (f, y) in enumerate(rows):
            found[r, :len(y)], label[r, :len(y)], on[r, :len(y)] = f, y, True
        r, t = np.nonzero(on)
        seen_emit, seen_move = np.zeros_like(self.emit), np.zeros_like(self.pass_on)
        for k in range(len(AROUND)):
            np.add.at(seen_emit[k], (found[r, t, k], label[r, t]), 1)
        pair = on[:, 1:]
        np.add.at(seen_move, (label[:, :-1][pair], label[:, 1:][pair]), 1)
        sum_emit, sum_move = np.full_like(self.emit, 1e-8), np.full_like(self.pass_on, 1e-8)
        first = np.zeros(LABELS)
        first[2::2] = -1e9
        for _ in range(rounds):
            score = sum(self.emit[k][found[:, :, k]] for k in range(len(AROUND)))
            move = self.moves()
            alpha, beta = np.zeros((n, most, LABELS)), np.zeros((n, most, LABELS))
            alpha[:, 0] = score[:, 0] + first
            for i in range(1, most):
                step = np.logaddexp.reduce(alpha[:, i - 1, :, None] + move, axis=1) + score[:, i]
                alpha[:, i] = np.where(on[:, i, None], step, alpha[:, i - 1])
            total = np.logaddexp.reduce(alpha[:, -1], axis=1)
            for i in range(most - 2, -1, -1):
                step = np.logaddexp.reduce(move + (score[:, i + 1] + beta[:, i + 1])[:, None, :], axis=2)
                beta[:, i] = np.where(on[:, i + 1, None], step, 0)
            share = np.exp(alpha + beta - total[:, None, None]) * on[..., None]
            grad_emit, grad_move = seen_emit - decay * self.emit * n, seen_move - decay * self.pass_on * n
            for k in range(len(AROUND)):
                np.add.at(grad_emit[k], found[r, t, k], -share[r, t])
            both = (alpha[:, :-1, :, None] + move + (score + beta)[:, 1:, None, :] - total[:, None, None, None])
            grad_move -= (np.exp(np.minimum(both, 0)) * pair[..., None, None]).sum(axis=(0, 1))
            sum_emit += grad_emit ** 2
            sum_move += grad_move ** 2
            self.emit += rate * grad_emit / np.sqrt(sum_emit)
            self.pass_on += rate * grad_move / np.sqrt(sum_move)

    def viterbi(self, found: np.ndarray, lengths: np.ndarray, opens: np.ndarray, closes: np.ndarray) -> np.ndarray:
        """Best labels of the runs that follow one another in ``found``. Where a
        run begins after (``opens``) or ends before (``closes``) a token that is
        outside by rule, the move from or to outside counts. Runs of like length
        are decoded together, so no batch is mostly padding."""
        out = np.zeros(len(found), np.int8)
        begins = np.cumsum(lengths) - lengths
        order = np.argsort(-lengths, kind="stable")
        move, first = self.moves().astype(np.float32), np.zeros(LABELS, np.float32)
        first[2::2] = -1e9
        at = 0
        while at < len(order):
            most = int(lengths[order[at]])
            batch = order[at:at + max(1, BATCH_TOKENS // most)]
            batch = batch[lengths[batch] * 2 >= most]
            at += len(batch)
            size, begin = lengths[batch], begins[batch]
            back = np.zeros((most, len(batch), LABELS), np.int8)
            best = self.scores(found[begin]).astype(np.float32) + np.where(opens[batch, None], move[0], first)
            for i in range(1, most):
                live = int(np.searchsorted(-size, -i))  # the runs longer than i come first
                ways = best[:live, :, None] + move
                back[i, :live] = ways.argmax(axis=1)
                best[:live] = ways.max(axis=1) + self.scores(found[begin[:live] + i])
            label = np.where(closes[batch, None], best + move[:, 0], best).argmax(axis=1)
            for i in range(most - 1, -1, -1):
                live = int(np.searchsorted(-size, -i))
                out[begin[:live] + i] = label[:live]
                if i:
                    label[:live] = back[i, np.arange(live), label[:live]]
        return out


def labelled(row: str) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of one marked line."""
    text, spans, last = "", [], 0
    for m in re.finditer(r"\[(\w+)\|([^\]]*)\]|\{(\w+)\|([^}]*)\}", row):
        text, kind, span = text + row[last:m.start()], m[1] or m[3], m[2] or m[4]
        spans.append((len(text), len(text) + len(span), KINDS.index(kind)))
        text, last = text + span, m.end()
    text += row[last:]
    start, end, shape, _ = tokens(text)
    y = np.zeros(len(start), np.int64)
    for a, b, kind in spans:
        inside = (start >= a) & (end <= b)
        y[inside] = 2 + 2 * kind
        y[np.flatnonzero(inside)[:1]] = 1 + 2 * kind
    return features(shape), y


def learn(rows: DataFrame, row_col: str = "row") -> Field:
    """A field from a small labelled table (a few hundred lines; the driver trains on it)."""
    field = Field()
    marked = [labelled(r[0]) for r in rows.select(F.col(f"`{row_col}`")).where(F.col(f"`{row_col}`").isNotNull()).collect()]
    marked = [x for x in marked if len(x[1])]
    if marked:
        field.train(marked)
    else:
        field.emit[..., 0] = 1.0  # nothing to go by: all outside
    return field


def added(field: Field, texts: list[str], known: list[list[tuple]]) -> list[list[tuple[int, int, str]]]:
    """The field's spans of each text that pass their check and overlap no known span."""
    found, lengths, opens, closes, where = [], [], [], [], []
    for number, text in enumerate(texts):
        at = 0
        for line in text.split("\n") if _HINT.search(text) else ():
            if _HINT.search(line):
                start, end, shape, free = tokens(line)
                if free.any():
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], free, [0]])))
                    found.append(features(shape)[free])
                    lengths.append(edge[1::2] - edge[::2])
                    opens.append(edge[::2] > 0)
                    closes.append(edge[1::2] < len(free))
                    where.append((number, start[free] + at, end[free] + at))
            at += len(line) + 1
    out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    if not found:
        return out
    lengths = np.concatenate(lengths)
    label = field.viterbi(np.concatenate(found), lengths, np.concatenate(opens), np.concatenate(closes))
    stops = np.zeros(len(label) + 1, bool)
    stops[np.cumsum(lengths)] = True  # a run ends before
    owner = np.repeat([w[0] for w in where], [len(w[1]) for w in where])
    start, end = np.concatenate([w[1] for w in where]), np.concatenate([w[2] for w in where])
    cover = [_cover(k) for k in known]
    for i in np.flatnonzero(label % 2 == 1).tolist():
        kind, j = (int(label[i]) - 1) // 2, i + 1
        while not stops[j] and label[j] == 2 + 2 * kind:
            j += 1
        which, a, b = int(owner[i]), int(start[i]), int(end[j - 1])
        span = texts[which][a:b]
        if not plausible(KINDS[kind], span):
            continue
        begins, ends = cover[which]
        before = bisect_left(begins, b)  # base spans that begin before this one's end
        if not before or ends[before - 1] <= a:
            out[which].append((a, b, KINDS[kind]))
    return out


def _cover(known: list[tuple]) -> tuple[list[int], list[int]]:
    """Starts of sorted spans, and up to each the furthest end."""
    ends: list[int] = []
    for _, b, _ in known:
        ends.append(max(b, ends[-1]) if ends else b)
    return [k[0] for k in known], ends


def spans(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with base and spans (base and added) as
    arrays of ``kind:start:end`` and the number of base spans of each kind."""
    def make() -> Callable:
        def show(found: list[tuple]) -> list[str]:
            return [f"{k}:{a}:{b}" for a, b, k in sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))]

        def run(texts: list) -> list[list]:
            texts = [t or "" for t in texts]
            known = [base(t) for t in texts]
            more = added(field, texts, known)
            return [*[[sum(k == kind for _, _, k in x) for x in known] for kind in KINDS],
                    [show(x) for x in known], [show(x + y) for x, y in zip(known, more)]]
        return run
    schema = ", ".join(f"n_{k} long" for k in KINDS) + ", base array<string>, spans array<string>"
    return map_texts(docs, make, schema, text_col, slice_rows=64)


def model(spark: SparkSession) -> Field:
    return learn(spark.createDataFrame([(r,) for r in LABELLED], "row string"))
