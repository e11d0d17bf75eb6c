"""Levenshtein automata intersected with the trie of a lexicon. States are made when a word first leads to them, and are forgotten when they fill their room."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

#: What a word ends as: no entry, an entry as spelt, a misspelling of one, or a word that begins with a stem.
NONE, EXACT, FUZZY, STEM = range(4)
#: Bytes of states after which they are made anew; words that go together, which may add theirs before that is seen; places of the trie that are stepped together.
ROOM, WORDS, STEPS = 64_000_000, 1 << 14, 50_000
_DEAD, _UNMADE = 0, -1


@dataclass(frozen=True)
class Entry:
    """A whole word, or a stem with any ending."""

    text: str
    stem: bool = False

    @property
    def edits(self) -> int:
        """Edits that a misspelling may have: none for stems and short words."""
        return 0 if self.stem or len(self.text) < 5 else 1 if len(self.text) < 9 else 2


@dataclass
class Trie:
    """Nodes of a lexicon as arrays; the edges of a node are first[node]:first[node + 1], by symbol. keys: node * symbols + symbol of each edge."""

    first: np.ndarray
    keys: np.ndarray
    symbol: np.ndarray
    child: np.ndarray
    #: Most edits of an entry below, and of the one that ends here (-1: none); whether a stem ends here.
    most: np.ndarray
    edits: np.ndarray
    stem: np.ndarray
    symbols: int

    @classmethod
    def of(cls, entries: list[Entry], number: dict[str, int]) -> Trie:
        children: list[dict[int, int]] = [{}]
        most, edits, stem = [-1], [-1], [False]
        for e in entries:
            node = 0
            for c in [None, *e.text]:
                if c is not None:
                    after = children[node].setdefault(number[c], len(children))
                    if after == len(children):
                        children.append({})
                        most.append(-1)
                        edits.append(-1)
                        stem.append(False)
                    node = after
                most[node] = max(most[node], e.edits)
            if edits[node] < 0 or e.stem:  # a stem outdoes the same word
                edits[node], stem[node] = e.edits, e.stem
        edges = [(i, s, n) for i, below in enumerate(children) for s, n in sorted(below.items())]
        at, symbol, child = (np.array([e[k] for e in edges], np.int64) for k in range(3))
        return cls(np.searchsorted(at, np.arange(len(children) + 1)), at * (len(number) + 1) + symbol, symbol, child, np.array(most), np.array(edits), np.array(stem), len(number) + 1)

    def below(self, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which node, edge) of all edges of some nodes."""
        n = self.first[node + 1] - self.first[node]
        which = np.repeat(np.arange(len(node)), n)
        return which, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[node], n)

    def follow(self, node: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which node, child) of the nodes that have a child by their symbol."""
        if not len(self.child):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        want = node * self.symbols + symbol
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        which = np.flatnonzero(self.keys[at] == want)
        return which, self.child[at[which]]


@dataclass
class Automaton:
    """Runs words through a lexicon. A state is the places that the letters read so far can have led to: (node, edits so far, letter of a swap still to come).

    Each state is an array of places, each place one number, and known by it; next[state, symbol] is filled when a word asks. Memory is ROOM and the states of
    WORDS words, whatever the lexicon and the text hold. symbols: by code point, 0 for all that no entry holds.
    """

    trie: Trie
    symbols: np.ndarray = field(repr=False)
    room: int = ROOM

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.places: list[np.ndarray] = []
        self.next, self.result = np.zeros((64, self.trie.symbols), np.int32), np.zeros(64, np.int8)
        self.used = 0
        zero = np.zeros(1, np.int64)
        _, self.start = self._number([zero[:0], self._closed(zero, zero, zero, zero)[1]])  # the same without entries
        self.next[_DEAD] = _DEAD

    def _number(self, found: list[np.ndarray]) -> np.ndarray:
        """Numbers of states, new ones added."""
        out = np.empty(len(found), np.int32)
        for i, places in enumerate(found):
            key = places.tobytes()
            at = self.known.get(key, _UNMADE)
            if at == _UNMADE:
                at = self.known[key] = len(self.places)
                self.places.append(places)
                if at == len(self.next):
                    self.next, self.result = np.concatenate([self.next, self.next]), np.concatenate([self.result, self.result])
                self.next[at], self.result[at] = _UNMADE, self._result(places)
                self.used += 2 * places.nbytes + 4 * self.trie.symbols + 200
            out[i] = at
        return out

    def _result(self, places: np.ndarray) -> int:
        node, swap, n = self._split(places)
        ends = (swap == 0) & (n <= self.trie.edits[node])
        stem = self.trie.stem[node[ends]]
        if (~stem & (n[ends] == 0)).any():
            return EXACT
        return STEM if stem.any() else FUZZY if ends.any() else NONE

    def _split(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = places >> 2
        return at // self.trie.symbols, at % self.trie.symbols, places & 3

    def _closed(self, owner: np.ndarray, node: np.ndarray, swap: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(owner, place) with letters left out, of each place the one with fewest edits; by owner and place."""
        parts = []
        while True:
            fits = n <= self.trie.most[node]
            owner, node, swap, n = owner[fits], node[fits], swap[fits], n[fits]
            if not len(owner):
                break
            parts.append((owner, (node * self.trie.symbols + swap) * 4 + n))
            plain = np.flatnonzero(swap == 0)
            which, edge = self.trie.below(node[plain])
            which = plain[which]
            owner, node, n = owner[which], self.trie.child[edge], n[which] + 1
            swap = np.zeros(len(owner), np.int64)
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        owner, place = (np.concatenate(p) for p in zip(*parts, strict=True))
        order = np.lexsort((place, owner))
        owner, place = owner[order], place[order]
        least = np.r_[True, (owner[1:] != owner[:-1]) | (place[1:] >> 2 != place[:-1] >> 2)]
        return owner[least], place[least]

    def _step(self, states: np.ndarray, symbol: np.ndarray) -> list[np.ndarray]:
        """The places of each state after its symbol."""
        trie, held = self.trie, [self.places[s] for s in states]
        owner = np.repeat(np.arange(len(held)), [len(p) for p in held])
        node, swap, n = self._split(np.concatenate(held))
        c = symbol[owner]
        parts = []

        def add(at: np.ndarray, to: np.ndarray, more: int = 0, wait: np.ndarray | int = 0) -> None:
            parts.append((owner[at], to, np.broadcast_to(wait, len(at)), n[at] + more))

        swapped = np.flatnonzero((swap > 0) & (swap == c))
        add(swapped, node[swapped])
        plain = np.flatnonzero(swap == 0)
        stems = plain[trie.stem[node[plain]] & (n[plain] == 0)]
        add(stems, node[stems])
        which, to = trie.follow(node[plain], c[plain])
        add(plain[which], to)
        free = plain[n[plain] < trie.most[node[plain]]]
        add(free, node[free], 1)  # a letter too many
        which, edge = trie.below(node[free])
        wrong = trie.symbol[edge] != c[free[which]]
        at, to, letter = free[which[wrong]], trie.child[edge[wrong]], trie.symbol[edge[wrong]]
        add(at, to, 1)
        which, later = trie.follow(to, c[at])
        add(at[which], later, 1, letter[which])
        owner, place = self._closed(*(np.concatenate(p) for p in zip(*parts, strict=True)))
        return np.split(place, np.searchsorted(owner, np.arange(1, len(held))))

    def _make(self, states: np.ndarray, symbols: np.ndarray) -> None:
        pairs = np.unique(states.astype(np.int64) * self.trie.symbols + symbols)
        states, symbols = pairs // self.trie.symbols, pairs % self.trie.symbols
        part = np.cumsum([len(self.places[s]) for s in states]) // STEPS
        for k in np.unique(part):
            at = part == k
            made = self._number(self._step(states[at], symbols[at]))
            self.next[states[at], symbols[at]] = made

    def run(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The result of each word codes[start:end], many words a character at a time; words leave as their states die."""
        out = np.zeros(len(starts), np.int8)
        if not hasattr(self, "known"):
            self._forget()
        for i in range(0, len(starts), WORDS):
            if self.used > self.room:
                self._forget()
            live = np.arange(i, min(len(starts), i + WORDS))
            live = live[:0] if self.start == _DEAD else live
            at, state = starts[live], np.full(len(live), self.start, np.int32)
            while len(live):
                ended = at >= ends[live]
                if ended.any():
                    out[live[ended]] = self.result[state[ended]]
                    live, state, at = live[~ended], state[~ended], at[~ended]
                symbol = self.symbols[np.minimum(codes[at], len(self.symbols) - 1)]
                after = self.next[state, symbol]
                unmade = after == _UNMADE
                if unmade.any():
                    self._make(state[unmade], symbol[unmade])
                    after = self.next[state, symbol]
                keep = after != _DEAD
                live, state, at = live[keep], after[keep], at[keep] + 1
        return out


def build(entries: list[Entry], room: int = ROOM) -> Automaton:
    """The automaton of some entries in lower case. Swapped neighbours are one edit, as is a letter too many, too few or wrong."""
    letters = sorted({c for e in entries for c in e.text})
    number = {c: i + 1 for i, c in enumerate(letters)}
    # A letter counts in either case, whatever its alphabet; the last symbol stands for all code points above.
    forms = {form for c in letters for form in (c, c.upper(), c.title()) if len(form) == 1}
    symbols = np.zeros(max(map(ord, forms), default=0) + 2, np.int32)
    for form in forms:
        symbols[ord(form)] = number.get(form.lower(), number.get(form, 0))
    return Automaton(Trie.of(entries, number), symbols, room)
