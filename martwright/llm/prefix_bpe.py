"""Byte-pair encoding by dynamic programming over prefixes.

Every prefix of a piece of text has exactly one encoding, and dropping the last token of an encoding
gives the encoding of a shorter prefix. So one token per position says everything: the last token of
the prefix that ends there. A token is the last one of a prefix exactly if it ends the prefix and can
stand after the last token of what is left, that is, if merging the two tokens' symbols by rank does
not reach over their border. An append only adds positions. After an edit the positions before it
still hold, and those behind it hold again as soon as two encodings meet in a token border.

Symbols are characters. For byte-level vocabularies each byte stands as the character of its number.
`ManyTexts` works out many short byte texts in step, one position of all of them after the other.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np

WIDE = 128  # bytes; longer texts do not go in step with others
IN_STEP = 1 << 13  # texts that go in step
NOTED = 20  # bits of the number of answers about pairs of tokens that `ManyTexts` notes
STEPS = 150_000  # remembered steps of the automaton besides its own
PAIRS = 150_000  # remembered answers about pairs of tokens; the memory starts anew beyond


class Merges:
    """Tokens with their merge ranks; `rank[token]` is lower for what merges earlier.

    A character that is no token is unknown and stays alone.
    """

    def __init__(self, rank: dict[str, int]):
        self.rank = rank
        self.token = {r: t for t, r in rank.items()}
        self._widths = {r: len(t) for t, r in rank.items()}
        self.longest = max(map(len, rank), default=1)
        self._split: dict[int, tuple[int, int]] = {}
        self._pairs: dict[tuple[int, int], bool] = {}
        reachable = [t for t in rank if len(t) == 1 or self._derive(t)]
        self.unreached = rank.keys() - reachable  # no merging ever makes these
        self._build_automaton(reachable)

    def _build_automaton(self, tokens: list[str]) -> None:
        """States are beginnings of tokens; the state at a position is the longest one that ends there.

        `_ends[state]` lists the tokens that end there, the longest first, each with its length.
        """
        step: dict[tuple[int, str], int] = {}
        own, parent = [-1], [(0, "")]
        for token in tokens:
            state = 0
            for c in token:
                following = step.get((state, c))
                if following is None:
                    following = step[state, c] = len(own)
                    own.append(-1)
                    parent.append((state, c))
                state = following
            own[state] = self.rank[token]
        depth = [0] * len(own)
        for state in range(1, len(own)):
            depth[state] = depth[parent[state][0]] + 1
        self._fallback = fallback = [0] * len(own)
        self._ends: list[tuple] = [()] * len(own)
        for state in sorted(range(1, len(own)), key=depth.__getitem__):
            before, c = parent[state]
            while before:
                before = fallback[before]
                if (before, c) in step:
                    fallback[state] = step[before, c]
                    break
            shorter = self._ends[fallback[state]]
            self._ends[state] = ((own[state], depth[state]), *shorter) if own[state] >= 0 else shorter
        self._step, self._steps = step, len(step)

    def _derive(self, token: str) -> bool:
        """Note the last merge that makes `token`; False if merging never makes it."""
        parts = self.merge(token, self.rank[token])
        if len(parts) != 2:
            return False
        self._split[self.rank[token]] = (self.rank[parts[0]], self.rank[parts[1]])
        return True

    def merge(self, text: str, below: int) -> list[str]:
        """Plain merging, lowest rank first and leftmost first, with ranks under `below` only."""
        rank, parts = self.rank, list(text)
        while True:
            best, at = below, -1
            for i in range(len(parts) - 1):
                r = rank.get(parts[i] + parts[i + 1])
                if r is not None and r < best:
                    best, at = r, i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _follows_noted(self, left: int, right: int) -> bool:
        if len(self._pairs) >= PAIRS:
            self._pairs.clear()
        known = self._pairs[left, right] = self.follows(left, right)
        return known

    def follows(self, left: int, right: int) -> bool:
        """Whether the encoding of both tokens' symbols is these two tokens."""
        # Take the two tokens apart, the youngest merge first. What meets at the border at each time
        # must not have merged before the merge just undone; of equal ranks the left one came first.
        rank, token, split = self.rank, self.token, self._split
        if left < 0 or right < 0:  # unknown symbols merge with nothing
            return True
        until_left = until_right = 1 << 62
        while True:
            r = rank.get(token[left] + token[right])
            if r is not None and r < until_left and r <= until_right:
                return False
            whole_left, whole_right = left not in split, right not in split
            if whole_left and whole_right:
                return True
            if not whole_left and (whole_right or left > right):
                until_left, left = left, split[left][1]
            else:
                until_right, right = right, split[right][0]

    def last_tokens(self, text: str, last: list[int] | None = None, until: int | None = None, states: list[int] | None = None) -> list[int]:
        """The last token of every prefix of `text`; -1 - c for an unknown character c.

        `last` may hold the answer for a prefix of `text`; it is extended in place, to `until` positions.
        `states`, if given, goes with `last`: the automaton's state at every position.
        """
        if last is None:
            last = []
        start = len(last)
        if states is None:
            states, state = [], 0
            for c in text[max(0, start - self.longest):start]:
                state = self._walk(state, c)
        else:
            state = states[start - 1] if start else 0
        step, walk, ends, pairs, follows, i = self._step.get, self._walk, self._ends, self._pairs.get, self._follows_noted, start
        for c in text[start:until]:
            following = step((state, c))
            state = walk(state, c) if following is None else following
            states.append(state)
            for t, width in ends[state]:
                k = i - width
                if k < 0:
                    last.append(t)
                    break
                known = pairs((last[k], t))
                if known or known is None and follows(last[k], t):
                    last.append(t)
                    break
            else:
                last.append(-1 - ord(c))
            i += 1
        return last

    def _walk(self, state: int, c: str) -> int:
        """The state behind `state` and `c`, by way of shorter ends; noted, so that it is one look-up from then on."""
        step, shorter = self._step, state
        while shorter and (shorter, c) not in step:
            shorter = self._fallback[shorter]
        found = step.get((shorter, c), 0)
        if len(step) < self._steps + STEPS:
            step[state, c] = found
        return found

    def encode_all(self, texts: list[str]) -> Iterator[list[int]]:
        """Encodings of texts in sorted order: what two neighbours begin with is worked out once."""
        before, last, states = "", [], []
        for text in texts:
            same = 0
            for a, b in zip(before, text):
                if a != b:
                    break
                same += 1
            del last[same:], states[same:]
            self.last_tokens(text, last, None, states)
            before = text
            yield self.path(last)

    def width(self, t: int) -> int:
        return 1 if t < 0 else self._widths[t]

    def path(self, last: Sequence[int]) -> list[int]:
        """The tokens of the whole text that `last` belongs to."""
        out, i, widths = [], len(last), self._widths
        while i:
            t = last[i - 1]
            out.append(t)
            i -= widths[t] if t >= 0 else 1
        out.reverse()
        return out

    def encode(self, text: str) -> list[int]:
        return self.path(self.last_tokens(text))

    def prefix_counts(self, last: Sequence[int], weight=lambda t: 1) -> list[int]:
        """The number of tokens of every prefix."""
        out: list[int] = []
        for i, t in enumerate(last):
            k = i - self.width(t)
            out.append((out[k] if k >= 0 else 0) + weight(t))
        return out

    def respliced(self, old: str, last: Sequence[int], start: int, stop: int, new: str) -> tuple[str, list[int]]:
        """Text and last tokens after `old[start:stop]` became `new`.

        Positions before `start` are kept. Behind the edit, work stops once as many last tokens in a
        row as the longest token is long are the old ones: whatever follows depends on no more than these.
        """
        text = old[:start] + new + old[stop:]
        fresh, shift, alike = list(last[:start]), len(text) - len(old), 0
        position = start
        while position < len(text):
            until = min(position + self.longest, len(text))
            self.last_tokens(text, fresh, until)
            for i in range(position, until):
                alike = alike + 1 if i - shift >= stop and fresh[i] == last[i - shift] else 0
                if alike == self.longest:
                    return text, fresh[:i + 1] + list(last[i - shift + 1:])
            position = until
        return text, fresh


class Table:
    """Numbers by distinct keys, both from 0 on, for many keys at a time; -1 for a key without one."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.bits, self.last = bits, (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        at = slots(keys, bits)
        while len(keys):
            free = np.flatnonzero(self.keys[at] < 0)
            some = free[np.unique(at[free], return_index=True)[1]]  # one for each slot
            self.keys[at[some]], self.values[at[some]] = keys[some], values[some]
            left = np.ones(len(keys), bool)
            left[some] = False
            keys, values, at = keys[left], values[left], (at[left] + 1) & self.last

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = slots(keys, self.bits)
        own = self.keys[at]
        found = np.where(own == keys, self.values[at], -1)
        some = np.flatnonzero((own != keys) & (own >= 0))
        keys, at = keys[some], at[some]
        while len(some):
            at = (at + 1) & self.last
            own = self.keys[at]
            found[some] = np.where(own == keys, self.values[at], -1)
            more = (own != keys) & (own >= 0)
            keys, at, some = keys[more], at[more], some[more]
        return found


def slots(keys: np.ndarray, bits: int) -> np.ndarray:
    """The upper bits of the keys times a large odd number."""
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


class ManyTexts:
    """Encodings of many byte texts by the same rules, the short ones in step.

    At each position the states and last tokens of all texts are worked out together.
    """

    def __init__(self, merges: Merges):
        self.merges = merges
        own = list(merges._step.items())[:merges._steps]
        self._step = Table(np.array([s << 8 | ord(c) for (s, c), _ in own], np.int64), np.array([s for _, s in own], np.int32))
        self._fallback = np.array(merges._fallback, np.int64)
        self._first = np.array([ends[0][0] if ends else -1 for ends in merges._ends], np.int64)  # the longest token that ends in a state
        size = max(merges.token, default=0) + 1
        self._shorter = np.full(size, -1, np.int64)  # the next shorter token that ends where a token does
        for ends in merges._ends:
            if len(ends) > 1:
                self._shorter[ends[0][0]] = ends[1][0]
        self._width, self._left, self._right = np.zeros(size, np.int64), np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        for r, width in merges._widths.items():
            self._width[r] = width
        for r, (left, right) in merges._split.items():
            self._left[r], self._right[r] = left, right
        rank, keys, ranks = merges.rank, [], []
        for token, r in rank.items():
            for k in range(1, len(token)):
                left, right = rank.get(token[:k]), rank.get(token[k:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    ranks.append(r)
        self._ranks = Table(np.array(keys, np.int64), np.array(ranks, np.int32))
        self._noted = np.full(1 << NOTED, -1, np.int64)  # pairs of tokens, and in the last bit whether the second follows the first

    def encode_all(self, texts: list[bytes], whole: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of ids of each; texts in `whole` are one token as they are."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        raw, starts = np.frombuffer(b"".join(texts), np.uint8), np.cumsum(lengths) - lengths
        alone = lengths > WIDE
        if whole:
            alone |= np.fromiter((t in whole for t in texts), bool, len(texts))
        counts = np.zeros(len(texts), np.int64)
        found = []  # texts, how many of their tokens follow, and tokens
        rest = sorted((bytes_as_text(texts[k]), k) for k in np.flatnonzero(alone).tolist())
        for (_, k), ids in zip(rest, self.merges.encode_all([t for t, _ in rest])):
            ids = [whole[texts[k]]] if texts[k] in whole else ids
            counts[k] = len(ids)
            found.append((np.full(len(ids), k), np.arange(len(ids))[::-1], np.array(ids, np.int32)))
        order = np.flatnonzero(~alone & (lengths > 0))
        order = order[np.argsort(-lengths[order], kind="stable")]
        for first in range(0, len(order), IN_STEP):
            some = order[first:first + IN_STEP]
            last = self._last_tokens(raw, starts[some], lengths[some])
            column, at = np.arange(len(some)), lengths[some] - 1
            behind = 0
            while len(column):
                tokens = last[at, column]
                found.append((some[column], behind, tokens))
                counts[some[column]] += 1
                behind += 1
                at = at - np.where(tokens >= 0, self._width[np.maximum(tokens, 0)], 1)  # an unknown symbol stands alone
                column, at = column[at >= 0], at[at >= 0]
        ends, ids = np.cumsum(counts), np.empty(int(counts.sum()), np.int32)
        for of, behind, tokens in found:
            ids[ends[of] - 1 - behind] = tokens
        return ids, counts

    def _last_tokens(self, raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The last token of every prefix, by position and text; the longest texts come first."""
        last = np.empty((int(lengths[0]), len(starts)), np.int32)
        states = np.zeros(len(starts), np.int64)
        for i, texts in enumerate(np.searchsorted(-lengths, -np.arange(len(last))).tolist()):  # longer than i
            letters = raw[starts[:texts] + i].astype(np.int64)
            states = self._walk(states[:texts], letters)
            row, some, tokens = last[i], np.arange(texts), self._first[states]
            while len(some):
                row[some] = np.where(tokens >= 0, tokens, -1 - letters[some])
                before = i - self._width[tokens]
                asked = np.flatnonzero((tokens >= 0) & (before >= 0))
                some, tokens, before = some[asked], tokens[asked], before[asked]
                left = last[before, some].astype(np.int64)
                asked = np.flatnonzero(left >= 0)  # unknown symbols merge with nothing
                asked = asked[~self._follows_noted(left[asked], tokens[asked])]
                some, tokens = some[asked], self._shorter[tokens[asked]]
        return last

    def _walk(self, states: np.ndarray, letters: np.ndarray) -> np.ndarray:
        found = self._step(states << 8 | letters).astype(np.int64)
        some = np.flatnonzero(found < 0)
        states = states[some]
        while len(some):
            found[some] = 0  # unless a shorter end goes on
            some, states = some[states > 0], self._fallback[states[states > 0]]
            following = self._step(states << 8 | letters[some])
            found[some] = following
            some, states = some[following < 0], states[following < 0]
        return found

    def _follows_noted(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pairs = left << 32 | right
        noted = self._noted[slots(pairs, NOTED)]
        known = (noted & 1).astype(bool)
        some = np.flatnonzero(noted >> 1 != pairs)
        if len(some):
            new, back = np.unique(pairs[some], return_inverse=True)
            fresh = self.follows(new >> 32, new & ((1 << 32) - 1))
            known[some] = fresh[back]
            self._noted[slots(new, NOTED)] = new << 1 | fresh
        return known

    def follows(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """`Merges.follows` for many pairs of tokens."""
        answers, some = np.ones(len(left), bool), np.arange(len(left))
        until_left, until_right = np.full(len(left), 1 << 62), np.full(len(left), 1 << 62)
        while len(some):
            r = self._ranks(left << 32 | right)
            no = (r >= 0) & (r < until_left) & (r <= until_right)
            answers[some[no]] = False
            whole_left, whole_right = self._left[left] < 0, self._left[right] < 0
            more = np.flatnonzero(~no & ~(whole_left & whole_right))
            on_left = (~whole_left & (whole_right | (left > right)))[more]
            some, left, right, until_left, until_right = some[more], left[more], right[more], until_left[more], until_right[more]
            until_left, left = np.where(on_left, left, until_left), np.where(on_left, self._right[left], left)
            until_right, right = np.where(on_left, until_right, right), np.where(on_left, right, self._left[right])
        return answers


def bytes_as_text(data: bytes) -> str:
    return data.decode("latin-1")


def from_ranks(lines: Iterable[bytes]) -> dict[str, int]:
    """Ranks of a file with base64 token and rank in each line, by tokens as text."""
    import base64

    pairs = (line.split() for line in lines if line.strip())
    return {bytes_as_text(base64.b64decode(t)): int(r) for t, r in pairs}
