"""The last-token table of many pieces at once, one byte position after another.

All pieces that are long enough take a step together: an automaton over the
vocabulary names the longest token that ends at the byte, and shorter ones are
tried until one may stand behind the last token of the prefix before it.
"""

from __future__ import annotations

import numpy as np

NEVER = 1 << 40
#: An odd factor that spreads keys over the slots of a table.
SPREAD = np.uint64(0x9E3779B97F4A7C15)
#: Slots (powers of two) of the table of pairs that were already judged.
JUDGED = 18


class _Automaton:
    """For each state the next one by byte and the longest token that ends there."""

    def __init__(self, tokens: list[bytes]):
        data = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        sizes = np.array([len(t) for t in tokens])
        starts = np.cumsum(sizes) - sizes
        node, parents, labels, levels, ends = np.zeros(len(tokens), np.int64), [], [], [], np.zeros(len(tokens), np.int64)
        count = 1
        for depth in range(int(sizes.max())):
            longer = np.flatnonzero(sizes > depth)
            keys, at = np.unique(node[longer] << 8 | data[starts[longer] + depth], return_inverse=True)
            node[longer] = at + count
            parents.append(keys >> 8)
            labels.append(keys & 255)
            levels.append(np.arange(count, count + len(keys)))
            count += len(keys)
        ends[:] = node
        self.next = np.zeros((count, 256), np.int32)
        self.token = np.full(count, -1, np.int32)
        self.token[ends] = np.arange(len(tokens))
        self.shorter = np.full(len(tokens), -1, np.int32)  # the next shorter token that ends alike
        back = np.zeros(count, np.int64)
        for parent, label, level in zip(parents, labels, levels):
            back[level] = np.where(parent > 0, self.next[back[parent], label], 0) if len(level) else 0
            own = self.token[level]
            inner = self.token[back[level]]
            self.shorter[own[own >= 0]] = inner[own >= 0]
            self.token[level] = np.where(own >= 0, own, inner)
            self.next[parent, label] = level
            self.next[level] = self.next[back[level]]


class PrefixSteps:
    """``tokens`` by rank; ``halves`` names for each token the two tokens whose
    merge makes it (-1 for a single byte, -2 if merges never make it)."""

    def __init__(self, tokens: list[bytes], halves: np.ndarray):
        self.sizes = np.array([len(t) for t in tokens], dtype=np.int64)
        self.automaton = _Automaton(tokens)
        self.left, self.right = halves[:, 0].astype(np.int64), halves[:, 1].astype(np.int64)
        self.made = self.left != -2
        self.since = np.where(self.left >= 0, np.arange(len(tokens)), -1)  # the merge that makes it
        rank_of = {t: i for i, t in enumerate(tokens)}
        pairs = [(a, b, i) for i, t in enumerate(tokens) for cut in range(1, len(t))
                 if (a := rank_of.get(t[:cut])) is not None and (b := rank_of.get(t[cut:])) is not None]
        a, b, rank = np.array(pairs, dtype=np.int64).reshape(-1, 3).T
        self._fill(a << 32 | b, rank)
        self._judged = np.full(1 << JUDGED, -1, np.int64)
        self._verdict = np.zeros(1 << JUDGED, bool)

    def _fill(self, keys: np.ndarray, ranks: np.ndarray) -> None:
        """A hash table with open slots: a pair goes to the first free one."""
        bits = max(4, int(len(keys)).bit_length() + 2)
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._keys, self._ranks = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NEVER, np.int64)
        slots = self._slots(keys)
        while len(keys):
            free = np.flatnonzero(self._keys[slots] == -1)
            slot, first = np.unique(slots[free], return_index=True)
            put = free[first]
            self._keys[slot], self._ranks[slot] = keys[put], ranks[put]
            rest = np.ones(len(keys), bool)
            rest[put] = False
            keys, ranks, slots = keys[rest], ranks[rest], (slots[rest] + 1) & self._mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * SPREAD) >> self._shift).astype(np.int64)

    def joined(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the token that the two make together; NEVER if there is none."""
        keys = a << 32 | b
        slots = self._slots(keys)
        ranks = np.full(len(keys), NEVER, np.int64)
        at = np.arange(len(keys))
        while len(at):
            seen = self._keys[slots]
            hit = seen == keys[at]
            ranks[at[hit]] = self._ranks[slots[hit]]
            on = ~hit & (seen != -1)
            at, slots = at[on], (slots[on] + 1) & self._mask
        return ranks

    def _walk(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merges leave the tokens side by side: their building is undone
        from the last merge on, and no two tokens that meet at the border may have
        a merge due while they do.  At equal ranks the left merge comes first."""
        fits = self.made[a] & self.made[b]
        at = np.flatnonzero(fits)
        a, b = a[at], b[at]
        due = np.full(len(at), NEVER, np.int64)  # merges below this rank would have joined the two
        while len(at):
            bad = self.joined(a, b) < due
            fits[at[bad]] = False
            since_a, since_b = self.since[a], self.since[b]
            on = ~bad & ((since_a >= 0) | (since_b >= 0))
            at, a, b, since_a, since_b = at[on], a[on], b[on], since_a[on], since_b[on]
            undo_b = since_b >= since_a  # the same merge is done on the left first, so undone on the right first
            due = np.where(undo_b, since_b + 1, since_a)
            a, b = np.where(undo_b, a, self.right[a]), np.where(undo_b, self.left[b], b)
        return fits

    def may_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``_walk`` with a table of judged pairs, where a new pair takes the slot of an old one."""
        keys = a << 32 | b
        slots = ((keys.astype(np.uint64) * SPREAD) >> np.uint64(64 - JUDGED)).astype(np.int64)
        fits, new = self._verdict[slots], np.flatnonzero(self._judged[slots] != keys)
        if len(new):
            fits[new] = self._walk(a[new], b[new])
            self._judged[slots[new]] = keys[new]
            # two new pairs may want one slot: the verdict must be of the pair that got it
            got = self._judged[slots[new]] == keys[new]
            self._verdict[slots[new[got]]] = fits[new[got]]
        return fits

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces one after another, number of ids of each piece)."""
        sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        order = np.argsort(-sizes, kind="stable")  # the pieces still going on are the first ones
        sizes = sizes[order]
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        starts = (np.cumsum(lengths := np.array([len(p) for p in pieces], dtype=np.int64)) - lengths)[order]
        longest = int(sizes[0]) if len(sizes) else 0
        last = np.full((longest, len(pieces)), -1, np.int32)
        state = np.zeros(len(pieces), np.int64)
        machine = self.automaton
        for step in range(longest):
            going = int(np.searchsorted(-sizes, -step, side="left"))
            state = machine.next[state[:going], data[starts[:going] + step]].astype(np.int64)
            at, token = np.arange(going), machine.token[state].astype(np.int64)
            while len(at):
                if token.min() < 0:
                    raise ValueError("a single byte is missing from the vocabulary")
                before = step - self.sizes[token]
                whole = before < 0
                fits = self.made[token]
                inner = np.flatnonzero(~whole)
                fits[inner] = self.may_follow(last[before[inner], at[inner]].astype(np.int64), token[inner])
                last[step, at[fits]] = token[fits]
                at, token = at[~fits], machine.shorter[token[~fits]].astype(np.int64)
        return self._walk_back(last, sizes, order)

    def _walk_back(self, last: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at, end, rounds = np.arange(len(sizes)), sizes.copy(), []
        counts = np.zeros(len(sizes), np.int64)
        while len(at := at[end[at] > 0]):
            token = last[end[at] - 1, at].astype(np.int64)
            end[at] -= self.sizes[token]
            counts[at] += 1
            rounds.append((at, token))
        by_piece = np.empty_like(counts)
        by_piece[order] = counts
        ends = np.cumsum(by_piece)
        flat = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
        place = ends[order]
        for i, (at, token) in enumerate(rounds):
            flat[place[at] - 1 - i] = token
        return flat, by_piece
