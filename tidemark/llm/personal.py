"""Personal data by rules and by a character-level bidirectional LSTM with a CRF.

Rules find e-mail addresses, IP addresses, card numbers and phone numbers of plain
shape. The network, trained on the driver from the spans that rules found in a bounded
sample of rows, and from the same spans written in other ways, labels every character of
every text. Windows overlap; in an overlap the window whose middle is nearer gives the
scores, and a CRF over kinds decodes one best path over the whole text, across windows.
Runs of one kind along it are the network's spans. Those that fail the checks of their
kind, or meet a span of the rules, or lie in one of their failed matches, are dropped;
the others are added.

A character is its first byte in UTF-8, so texts need no decoding to be read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.recurrent import LANES, Adam, Bidirectional, gathered, windows_of
from tidemark.llm.samples import least_hashed, window_at
from tidemark.llm.words import chunks
from tidemark.llm.workers import importable

KINDS = ("email", "ip", "card", "phone")
HIDDEN = 12
#: Rows that training sees at most, with and without spans, and characters of the window of each.
TRAINING_ROWS, TRAINING_CHARS = 2500, 6000
STEPS, BATCH, TRAINING_WINDOW, RATE = 600, 128, 80, 0.02
#: Part of the spans that training writes in another way.
REWRITTEN = 0.6
#: Characters per window when texts are read, and of the overlap of two.
WINDOW, OVERLAP = 256, 64
#: What stands around "at" and "dot", or between digits, in the spans that training writes anew.
AROUND = (("[", "]"), ("(", ")"), (" ", " "), (" [", "] "), (" (", ") "), ("*", "*"), ("-", "-"), ("_", "_"), ("|", "|"), (" -", "- "))

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_AT = re.compile(r"(?i)[\W_]*(@|(?<![a-z])at(?![a-z]))")
_DOT_FIRST = re.compile(r"(?i)[\W_]*(\.|dot(?![a-z0-9]))")
_DOT_LAST = re.compile(r"(?i)(\.|(?<![a-z0-9])dot)[\W_]*$")
_DOT_NAME = re.compile(r"(?i)[\W_]{1,2}dot[\W_]{1,2}[a-z0-9-]+")
_MARKS = re.compile(r"(?i)[^A-Za-z0-9\n]{0,3}|[\W_]{1,2}dot[\W_]{1,2}")
_BEFORE = re.compile(r"(?i)[+(]?[0-9]+([^A-Za-z0-9\n]{1,3}|[\W_]{1,2}dot[\W_]{1,2})$")
_AFTER = re.compile(r"(?i)([^A-Za-z0-9\n]{1,3}|[\W_]{1,2}dot[\W_]{1,2})[0-9]+")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def is_card(text: str) -> bool:
    d = digits_of(text)
    return 13 <= len(d) <= 19 and luhn(d)


def is_ip(parts: list[str]) -> bool:
    return len(parts) == 4 and all(p.lstrip("0") == "" or len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in parts)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the address pattern. A match is the whole run of local
    characters before an @ with a domain after it, so that each is found from its @."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and not _NOT_LOCAL.match(text, start - 1, start):
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
            at = text.find("@", done)
        else:
            done = at + 1
            at = text.find("@", done)


def _addresses(text: str) -> Iterator[tuple[int, int, bool]]:
    for run in _NUMBERS.finditer(text):
        parts = run.group().split(".")
        at = run.start()
        for k in range(0, len(parts) - 3, 4):
            own = parts[k:k + 4]
            end = at + sum(map(len, own)) + 3
            yield at, end, is_ip(own)
            at = end + 1


def matches(text: str) -> tuple[list[Span], list[Span]]:
    """(spans, failed matches) of the rules, by kind, then start, in code points."""
    good: list[Span] = []
    bad: list[Span] = []
    if "@" in text:
        good += [("email", a, b) for a, b in _emails(text)]
    for a, b, ok in _addresses(text):
        (good if ok else bad).append(("ip", a, b))
    for m in _CARD.finditer(text):
        (good if is_card(m.group()) else bad).append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            (good if 9 <= len(digits_of(m.group())) <= 15 else bad).append(("phone", m.start(), m.end()))
    return good, bad


def plausible(kind: str, text: str) -> bool:
    """Whether a span of the network may be of its kind."""
    d = digits_of(text)
    if kind == "email":
        return len(text) >= 8 and re.search(r"(?i)@|(?<![a-z])at(?![a-z])", text) is not None and re.search(r"(?i)[a-z0-9][\W_]*(\.|(?<![a-z])dot(?![a-z]))[\W_]*[a-z]", text) is not None
    if kind == "ip":
        return is_ip(re.findall(r"[0-9]+", text)) and re.fullmatch(r"(?i)[0-9]+(([\W_]{1,3}|[\W_]{1,2}dot[\W_]{1,2})[0-9]+){3}", text) is not None
    if kind == "card":
        return is_card(text) and re.fullmatch(r"[0-9]([\W_]{0,3}[0-9])+", text) is not None
    return 9 <= len(d) <= 15 and re.fullmatch(r"\+?\s?\(?[0-9][0-9().\-\x20/]*[0-9]", text) is not None


class Crf:
    """Transitions between labels 0 (none) and kinds; a kind passes to itself or none."""

    def __init__(self, labels: int):
        self.labels = labels
        self.moves = np.zeros((labels, labels), np.float32)
        self.allowed = np.eye(labels, dtype=bool)
        self.allowed[0], self.allowed[:, 0] = True, True

    def weights(self) -> np.ndarray:
        return np.where(self.allowed, self.moves, np.float32(-1e4))

    def gradients(self, scores: np.ndarray, path: np.ndarray, lengths: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """(loss, gradient of the scores, of the moves) of paths (time, windows)."""
        steps, n, k = scores.shape
        w = self.weights().astype(np.float64)
        s = scores.astype(np.float64)
        live = np.arange(steps)[:, None] < lengths[None, :]
        alpha = np.empty((steps, n, k))
        alpha[0] = s[0]

        def total(x: np.ndarray, axis: int) -> np.ndarray:
            m = x.max(axis=axis, keepdims=True)
            return (m + np.log(np.exp(x - m).sum(axis=axis, keepdims=True))).squeeze(axis)

        for t in range(1, steps):
            alpha[t] = np.where(live[t][:, None], total(alpha[t - 1][:, :, None] + w[None], 1) + s[t], alpha[t - 1])
        z = total(alpha[-1], 1)
        beta = np.zeros((n, k))
        grad = np.zeros_like(s)
        moves = np.zeros((k, k))
        for t in range(steps - 1, -1, -1):
            grad[t] = np.exp(alpha[t] + beta - z[:, None]) * live[t][:, None]
            if t:
                ahead = (s[t] + beta)[:, None, :] + w[None]
                moves += (np.exp(alpha[t - 1][:, :, None] + ahead - z[:, None, None]) * live[t][:, None, None]).sum(axis=0)
                beta = np.where(live[t][:, None], total(ahead, 2), beta)
        tt, nn = np.nonzero(live)
        gold = s[tt, nn, path[tt, nn]].sum()
        np.subtract.at(grad, (tt, nn, path[tt, nn]), 1)
        tt, nn = np.nonzero(live[1:])
        gold += w[path[tt, nn], path[tt + 1, nn]].sum()
        np.subtract.at(moves, (path[tt, nn], path[tt + 1, nn]), 1)
        return float((z.sum() - gold) / n), (grad / n).astype(np.float32), np.where(self.allowed, moves / n, 0).astype(np.float32)

    def open(self, scores: np.ndarray) -> np.ndarray:
        """Positions at which the best path may have a kind. At the others none scores so
        much more that any path with a kind there gains by none in its place, whatever the
        labels beside it, or beyond a text's ends."""
        w = self.moves
        enter, leave, stay, none = w[0, 1:], w[1:, 0], np.diag(w)[1:], w[0, 0]
        cases = [2 * stay - enter - leave, stay - none, enter + leave - 2 * none, leave - none, enter - none, stay - enter, stay - leave, 0 * stay]
        gain = np.max(cases, axis=0) + np.float32(1e-4)  # with room for rounding
        over = scores.reshape(-1, self.labels) @ np.vstack([-np.ones((1, self.labels - 1), np.float32), np.eye(self.labels - 1, dtype=np.float32)])
        return (over > -gain).any(axis=1).reshape(scores.shape[:-1])

    def decode(self, scores: np.ndarray, sizes: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Best paths (time, stretches) over the first `sizes` positions of each stretch,
        with none beside it where `before` and `after` say so, else nothing."""
        steps, n, k = scores.shape
        w = self.weights()
        back = np.empty((steps, n, k), np.int8)
        best = scores[0] + np.where(before[:, None], w[0], 0)
        last = np.where((sizes == 1)[:, None], best, 0)
        for t in range(1, steps):
            options = best[:, :, None] + w[None]
            back[t] = options.argmax(axis=1)
            best = options.max(axis=1) + scores[t]
            last[sizes == t + 1] = best[sizes == t + 1]
        path = np.zeros((steps, n), np.int8)
        rows = np.arange(n)
        now = (last + np.where(after[:, None], w[:, 0], 0)).argmax(axis=1).astype(np.int8)
        for t in range(steps - 1, -1, -1):
            live = t < sizes
            path[t, live] = now[live]
            if t:
                now = np.where(live, back[t, rows, now], now)
        return path


def symbols_of(text: str) -> np.ndarray:
    """First bytes of a text's characters."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    return data[(data & 0xC0) != 0x80]


def written_anew(kind: str, own: str, rng: np.random.Generator) -> str:
    """A span in another way of writing, which the rules mostly do not match."""
    def one(*ways: str) -> str:
        return ways[rng.integers(len(ways))]

    def word(*ways: str) -> str:
        a, b = AROUND[rng.integers(len(AROUND))]
        w = one(*ways)
        return a + (w, w.upper(), w.capitalize())[rng.integers(3)] + b

    if kind == "email":
        name, domain = own.split("@")
        at = word("at") if rng.random() < 0.7 else one(" @ ", "@ ", " @", "[@]", "(@)")
        dot = word("dot") if rng.random() < 0.7 else one(".", " . ", "[.]")
        return (name if rng.random() < 0.5 else name.replace(".", dot)) + at + domain.replace(".", dot)
    if kind == "phone":
        digits = digits_of(own)
        if rng.random() < 0.3:
            return re.sub(r"^\+[0-9]+\s*", "", own)
        cuts = sorted({len(digits) - 4, len(digits) - 7, max(len(digits) - 10, 0), 0})
        groups = [digits[x:y] for x, y in zip(cuts, [*cuts[1:], len(digits)])]
        if len(groups) > 2 and rng.random() < 0.3:
            groups[-3] = f"({groups[-3]})"
        return one("", "", "00", "00 ", "(0) ", "+ ") + one(" ", ".", "-", "/", " - ").join(groups)
    if kind == "ip":
        return own.replace(".", word("dot") if rng.random() < 0.3 else one(" . ", "[.]", "(.)", ". ", "-", "_", ":"))
    digits = digits_of(own)
    size = int(rng.integers(3, 6)) if rng.random() < 0.3 else 4
    return one(".", "/", "_", "  ", " - ", ":", "|", ", ").join(digits[x:x + size] for x in range(0, len(digits), size))


class PersonalModel:
    def __init__(self, seed: int = 5):
        self.net = Bidirectional(4, HIDDEN, len(KINDS) + 1, seed)
        self.crf = Crf(len(KINDS) + 1)

    def train(self, texts: list[str], seed: int = 5) -> "PersonalModel":
        """From texts and the rules' spans in them: half of the windows hold one,
        which REWRITTEN of them write in another way; the others hold digits or anything."""
        rng = np.random.default_rng(seed)
        found = [matches(t) for t in texts]
        spans = [(i, s) for i, (good, _) in enumerate(found) for s in good]
        near = [(i, m.start()) for i, t in enumerate(texts) for m in re.finditer(r"[0-9]{3,}|@", t) if not any(a - 4 < m.start() < b + 4 for _, a, b in found[i][0])]
        filled = [i for i, t in enumerate(texts) if t]
        by_kind = [[x for x in spans if x[1][0] == kind] for kind in KINDS]
        ready = [x for x in by_kind if x]
        if not ready:
            # nothing to learn from: no label but none
            self.net.out[:], self.net.bias[:] = 0, 0
            self.net.bias[0] = 20
            return self
        parameters = [*self.net.parameters(), self.crf.moves]
        opt = Adam(parameters, RATE)
        for step in range(STEPS):
            pieces, paths = [], []
            for b in range(BATCH):
                if b % 2 == 0:
                    own = ready[rng.integers(len(ready))]
                    i, span = own[rng.integers(len(own))]
                    text, marks = self._around(texts[i], found[i][0], span, rng)
                elif b % 4 == 1 and near:
                    i, at = near[rng.integers(len(near))]
                    text, marks = self._cut(texts[i], found[i][0], at - int(rng.integers(TRAINING_WINDOW)))
                else:
                    i = filled[rng.integers(len(filled))]
                    text, marks = self._cut(texts[i], found[i][0], int(rng.integers(len(texts[i]))) - TRAINING_WINDOW // 2)
                path = np.zeros(TRAINING_WINDOW, np.int64)
                for kind, a, z in marks:
                    path[max(a, 0):max(z, 0)] = KINDS.index(kind) + 1
                pieces.append(symbols_of(text))
                paths.append(path)
            lengths = np.array([len(p) for p in pieces])
            ends = np.cumsum(lengths)
            symbols = gathered(np.concatenate(pieces), ends - lengths, ends, TRAINING_WINDOW)
            scores, kept = self.net.forward(symbols)
            _, grad, moves = self.crf.gradients(scores, np.stack(paths, axis=1), lengths)
            opt.step([*self.net.backward(kept, grad), moves], 1 - step / STEPS)
        return self

    @staticmethod
    def _cut(text: str, spans: list[Span], start: int) -> tuple[str, list[Span]]:
        start = max(0, min(start, len(text) - TRAINING_WINDOW))
        return text[start:start + TRAINING_WINDOW], [(k, a - start, b - start) for k, a, b in spans if a < start + TRAINING_WINDOW and b > start]

    def _around(self, text: str, spans: list[Span], span: Span, rng: np.random.Generator) -> tuple[str, list[Span]]:
        kind, a, b = span
        own = text[a:b]
        if rng.random() < REWRITTEN:
            own = written_anew(kind, own, rng)
        before = text[max(0, a - TRAINING_WINDOW):a]
        before = before[len(before) - min(len(before), int(rng.integers(0, max(1, TRAINING_WINDOW - min(len(own), 40))))):]
        whole = before + own + text[b:b + TRAINING_WINDOW]
        marks = [(k, x - a + len(before), y - a + len(before)) for k, x, y in spans if y <= a] + [(kind, len(before), len(before) + len(own))]
        shift = len(before) + len(own) - b
        marks += [(k, x + shift, y + shift) for k, x, y in spans if x >= b]
        return whole[:TRAINING_WINDOW], marks

    def runs(self, symbols: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(text, label, start, end) of the runs of kinds along each text's best path."""
        lengths = np.diff(offsets)
        text, first = windows_of(lengths, WINDOW, WINDOW - OVERLAP)
        starts, ends = offsets[text] + first, offsets[text + 1]
        # what each window gives: from the middle of the overlap before it to that of the one after
        begin = np.where(first > 0, first + OVERLAP // 2, 0)
        stop = np.where(np.append(text[1:], -1) == text, first + WINDOW - OVERLAP // 2, lengths[text])
        places, values = [np.zeros(0, np.int64)], [np.zeros((0, self.crf.labels), np.float32)]
        for at in range(0, len(text), LANES):
            own = slice(at, at + LANES)
            size = int(min(WINDOW, (ends[own] - starts[own]).max()))
            scores = self.net.scores(gathered(symbols, starts[own], ends[own], size))
            step, lane = np.nonzero(self.crf.open(scores))
            position = step + first[own][lane]
            given = (position >= begin[own][lane]) & (position < stop[own][lane])
            places.append((position + offsets[text[own][lane]])[given])
            values.append(scores[step[given], lane[given]])
        place, value = np.concatenate(places), np.concatenate(values)
        order = np.argsort(place, kind="stable")
        return self._decoded(place[order], value[order], offsets)

    def _decoded(self, place: np.ndarray, value: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int]]:
        """Runs from the scores of the open positions. All other positions are none, so the
        stretches of open ones between them are decoded apart, those of like length together."""
        if not len(place):
            return []
        text = np.searchsorted(offsets, place, "right") - 1
        new = np.append(True, (np.diff(place) > 1) | (np.diff(text) > 0))
        head = np.flatnonzero(new)
        size = np.diff(np.append(head, len(place)))
        inner = place[head] > offsets[text[head]], place[head] + size < offsets[text[head] + 1]
        label = np.zeros(len(place), np.int8)
        doubling = np.ceil(np.log2(size)).astype(int)
        for group in np.unique(doubling):
            same = np.flatnonzero(doubling == group)
            for part in np.array_split(same, -(-len(same) * (1 << int(group)) // (1 << 21))):
                longest = int(size[part].max())
                step = np.arange(longest)
                live = step[None, :] < size[part][:, None]
                scores = np.zeros((len(part), longest, self.crf.labels), np.float32)
                scores[live] = value[(head[part][:, None] + step)[live]]
                path = self.crf.decode(np.ascontiguousarray(scores.transpose(1, 0, 2)), size[part], inner[0][part], inner[1][part])
                label[(head[part][:, None] + step)[live]] = path.T[live]
        turn = np.flatnonzero(np.append(True, new[1:] | (label[1:] != label[:-1])))
        end = np.append(turn[1:], len(place))
        base = offsets[text[turn]]
        return [(int(t), int(k), int(a), int(z)) for t, k, a, z in zip(text[turn], label[turn], place[turn] - base, place[end - 1] + 1 - base) if k]

    def added(self, text: str, runs: list[tuple[int, int, int]], good: list[Span], bad: list[Span]) -> list[Span]:
        """Spans of runs (label, start, end) of a text, besides the rules' own. Runs over
        digits that stand close are one. The ends of a run are put right: words, numbers and
        names joined by a dot belong to it whole. The network's kind is tried first, then
        the kinds whose check is strict."""
        out: list[Span] = []
        taken: list[list[int]] = []  # union of the rules' spans
        for _, a, b in sorted(good, key=lambda g: g[1]):
            if taken and a <= taken[-1][1]:
                taken[-1][1] = max(taken[-1][1], b)
            else:
                taken.append([a, b])
        stops = [b for _, b in taken]
        failed = {k: [(a, b) for w, a, b in bad if w == k] for k in KINDS}  # by start, none meet

        def clear(k: str, x: int, y: int) -> bool:
            i = bisect_right(stops, x)
            own = failed[k]
            j = bisect_right(own, (x, len(text))) - 1
            return not (i < len(taken) and taken[i][0] < y) and not (out and out[-1][2] > x) and not (j >= 0 and own[j][1] >= y)

        for label, a, b in _together(text, _outside(runs, taken, stops)):
            while a < b and text[a].isspace():
                a += 1
            while b > a and (text[b - 1].isspace() or text[b - 1] in ".,;:"):
                b -= 1
            if a == b:
                continue
            kind = KINDS[label - 1]
            ends = [_named_whole(text, a, b)] if kind == "email" else _numbers_whole(text, a, b)
            ways = [(k, *e) for k in dict.fromkeys((kind, "ip", "card") if kind != "email" else (kind,)) for e in ends]
            if kind in ("card", "ip"):
                ways += [("phone", *e) for e in ends if text[e[0]] in "+(0"]
            for k, x, y in ways:
                if clear(k, x, y) and plausible(k, text[x:y]):
                    out.append((k, x, y))
                    break
        return out


def _outside(runs: list[tuple[int, int, int]], taken: list[list[int]], stops: list[int]) -> list[tuple[int, int, int]]:
    """What of the runs lies outside the intervals `taken`, which end at `stops`."""
    out = []
    for label, a, b in runs:
        i = bisect_right(stops, a)
        while a < b and i < len(taken) and taken[i][0] < b:
            if a < taken[i][0]:
                out.append((label, a, taken[i][0]))
            a = max(a, taken[i][1])
            i += 1
        if a < b:
            out.append((label, a, b))
    return out


def _together(text: str, runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Runs in order; those of digit kinds with no letter and few marks between are one, of the longest's kind."""
    out: list[tuple[int, int, int]] = []
    widest = 0
    for label, a, b in sorted(runs, key=lambda r: r[1]):
        digits = KINDS[label - 1] != "email"
        if out and digits and KINDS[out[-1][0] - 1] != "email" and _MARKS.fullmatch(text, out[-1][2], a):
            out[-1] = (label if b - a > widest else out[-1][0], out[-1][1], b)
            widest = max(widest, b - a)
        else:
            out.append((label, a, b))
            widest = b - a
    return out


def _numbers_whole(text: str, a: int, b: int) -> list[tuple[int, int]]:
    """A run over digits with its first and last number whole; then with the marks and the
    number before it, with those after it, and with both."""
    while a < b and text[a] not in "+(" and not "0" <= text[a] <= "9":
        a += 1
    while b > a and not "0" <= text[b - 1] <= "9":
        b -= 1
    while 0 < a < b and "0" <= text[a] <= "9" and "0" <= text[a - 1] <= "9":
        a -= 1
    while a < b < len(text) and "0" <= text[b] <= "9":
        b += 1
    if a >= b:
        return []
    before = _BEFORE.search(text[max(0, a - 12):a])
    after = _AFTER.match(text, b)
    left = a - len(before.group()) if before else a
    right = after.end() if after else b
    return list(dict.fromkeys([(a, b), (left, b), (a, right), (left, right)]))


def _named_whole(text: str, a: int, b: int) -> tuple[int, int]:
    """The ends of an address: its first and last word whole, with the name before a dot it
    begins with and the names after dots that follow, without words that no dot joins to it."""
    word = lambda c: c.isascii() and c.isalnum()
    while 0 < a < b and word(text[a]) and word(text[a - 1]):
        a -= 1
    while a < b < len(text) and word(text[b - 1]) and word(text[b]):
        b += 1
    while more := _DOT_NAME.match(text, b):
        b = more.end()
    if _DOT_FIRST.match(text, a, b):
        name = re.search(r"[A-Za-z0-9%+-]+\s?$", text[max(0, a - 64):a])
        a -= len(name.group()) if name else 0
    at = _AT.search(text, a, b)
    local = text[a:at.start()] if at else ""
    loose = [g.end() for g in re.finditer(r"\s+", local) if not (_DOT_LAST.search(local[:g.start()]) or _DOT_FIRST.match(local, g.end()))]
    if loose and loose[-1] < len(local):
        a += loose[-1]
    return a, b


def trained(rows: DataFrame, limit: int = TRAINING_ROWS) -> PersonalModel:
    """A model from `limit` rows of (doc_id, text) at most, four in five with digits or an @,
    chosen by a hash of the row, and of a window anywhere in each: the same on every run."""
    hashed = rows.filter("length(text) > 0").withColumn("h", F.xxhash64("doc_id", "text"))
    known = hashed.select(window_at("text", TRAINING_CHARS, F.xxhash64("h")).alias("text"), "h")
    marked = least_hashed(known.filter(F.col("text").rlike("[0-9]{4}|@|[0-9][.][0-9]")), limit * 4 // 5, "text")
    plain = least_hashed(known, limit // 5, "text")
    return PersonalModel().train([r.text for r in [*marked, *plain]])


def found_spans(docs: DataFrame, model: PersonalModel) -> DataFrame:
    """(doc_id, base, spans) of every row of (doc_id, text): arrays of (kind, start, end),
    by kind and start, in code points, end exclusive; `spans` holds `base` and what the
    network adds. Null and empty texts have none. Repeated rows are returned each."""
    spark = docs.sparkSession
    importable(spark)
    sent = spark.sparkContext.broadcast(model)
    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        marks = np.zeros(256, bool)
        marks[48:58] = marks[ord("@")] = True
        for batch in batches:
            ids = batch.column(0)
            for first, data, offsets in chunks(batch.column(1)):
                starts = (data & 0xC0) != 0x80
                places = np.concatenate(([0], np.cumsum(starts)))[offsets]
                runs: dict[int, list[tuple[int, int, int]]] = {}
                for i, label, a, b in own.runs(data[starts], places):
                    runs.setdefault(i, []).append((label, a, b))
                marked = np.concatenate(([0], np.cumsum(marks[data])))[offsets]
                base: list[list[dict]] = []
                every: list[list[dict]] = []
                for i in range(len(offsets) - 1):
                    good: list[Span] = []
                    bad: list[Span] = []
                    more: list[Span] = []
                    if marked[i + 1] > marked[i] or i in runs:
                        text = data[offsets[i]:offsets[i + 1]].tobytes().decode("utf-8", "replace")
                        good, bad = matches(text)
                        more = own.added(text, runs.get(i, []), good, bad)
                    base.append(good)
                    every.append(sorted([*good, *more], key=lambda s: (KINDS.index(s[0]), s[1], s[2])))
                as_structs = lambda lists: pa.array([[dict(zip(("kind", "start", "end"), s)) for s in x] for x in lists], pa.list_(kind))
                yield pa.RecordBatch.from_arrays([ids.slice(first, len(base)), as_structs(base), as_structs(every)], names=["doc_id", "base", "spans"])

    one = "array<struct<kind: string, start: int, end: int>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(find, f"doc_id long, base {one}, spans {one}")


def as_text(spans: str) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op7_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of all documents; the counts are those of the rules' spans."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = found_spans(docs, trained(docs))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(as_text("base"), 256).alias("base_sha256"), as_text("spans").alias("spans"))
