"""Levenshtein automata run against a lexicon trie.

``Matcher`` holds a trie of terms.  A text word is read once, character by
character; the state is the set of trie nodes reachable with their number of
edits, which is the product of the trie with the Levenshtein automata of all
its terms.  States and transitions are made when first met and kept, so that
a word costs a dictionary look-up for each character until no term is left.
Beyond ``STATES`` of them they are made anew.
"""

from __future__ import annotations

#: Terms shorter than the first match only as they are, those shorter than the second by one edit at most.
FUZZY_LENGTH, TWO_EDITS_LENGTH = 4, 8
STATES = 200_000


class Matcher:
    """Words within ``edits`` edits of a term, or beginning with a stem.

    An edit is a character too many, too few or another one, and with
    ``swaps`` also two neighbours in the other order.

    ``terms`` and ``stems`` map a text to any value; ``match`` gives
    (value, edits) of the closest one (the smaller text if two are as close),
    or None.  Words in ``clean`` match only by 0 edits.
    """

    def __init__(self, terms: dict, stems: dict, clean=(), edits: int = 1, swaps: bool = False):
        self.terms, self.stems, self.clean, self.edits, self.swaps = dict(terms), dict(stems), frozenset(clean), edits, swaps
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.stem: list[str | None] = [None]
        self.longest: list[int] = [0]
        for table, ends in ((self.terms, self.term), (self.stems, self.stem)):
            for text in sorted(table):
                node = 0
                for ch in text:
                    self.longest[node] = max(self.longest[node], len(text) if table is self.terms else 0)
                    node = self.children[node].setdefault(ch, len(self.children))
                    if node == len(self.term):
                        self.children.append({})
                        self.term.append(None)
                        self.stem.append(None)
                        self.longest.append(0)
                self.longest[node] = max(self.longest[node], len(text) if table is self.terms else 0)
                ends[node] = text
        self.allowed = [self._edits_of(n) for n in self.longest]
        self._forget()

    def _edits_of(self, length: int) -> int:
        return min(self.edits, (length >= FUZZY_LENGTH) + (length >= TWO_EDITS_LENGTH))

    def _forget(self) -> None:
        self.ids: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.accepts: list[tuple | None] = []
        self.moves: list[dict[str, int]] = []
        self.start = self._state({0: 0}, {}, None)

    def _closed(self, nodes: dict[int, int]) -> dict[int, int]:
        """With the characters of a term left out."""
        todo = list(nodes.items())
        while todo:
            node, e = todo.pop()
            if e < self.edits:
                for child in self.children[node].values():
                    if self.allowed[child] > e and nodes.get(child, 9) > e + 1:
                        nodes[child] = e + 1
                        todo.append((child, e + 1))
        return nodes

    def _state(self, nodes: dict[int, int], swapped: dict[tuple[int, str], int], stem: str | None) -> int:
        """``swapped``: the nodes reached if the next character is the first of two neighbours in the other order."""
        nodes = self._closed(dict(nodes))
        own = (tuple(sorted(nodes.items())), tuple(sorted(swapped.items())), stem)
        if own not in self.ids:
            if not nodes and not swapped and stem is None:
                return -1
            self.ids[own] = len(self.states)
            self.states.append(own)
            self.moves.append({})
            found = [(e, self.term[n]) for n, e in nodes.items() if self.term[n] and e <= self._edits_of(len(self.term[n]))]
            best = min(found, default=None)
            if stem is not None and (best is None or best[0] > 0):
                self.accepts.append((self.stems[stem], 0))
            else:
                self.accepts.append((self.terms[best[1]], best[0]) if best else None)
        return self.ids[own]

    def _move(self, state: int, ch: str) -> int:
        nodes, waiting, stem = self.states[state]
        new: dict[int, int] = {}
        swapped: dict[tuple[int, str], int] = {}
        for (node, first), e in waiting:
            if first == ch and new.get(node, 9) > e:
                new[node] = e
        for node, e in nodes:
            child = self.children[node].get(ch)
            if child is not None and self.allowed[child] >= e and new.get(child, 9) > e:
                new[child] = e
            if e < self.edits:
                if self.allowed[node] > e and new.get(node, 9) > e + 1:
                    new[node] = e + 1  # a character too many
                for first, other in self.children[node].items():
                    if self.allowed[other] > e:
                        if new.get(other, 9) > e + 1:
                            new[other] = e + 1  # another character
                        both = self.children[other].get(ch) if self.swaps and first != ch else None
                        if both is not None and self.allowed[both] > e and swapped.get((both, first), 9) > e + 1:
                            swapped[both, first] = e + 1
        for node, e in new.items():
            if e == 0 and self.stem[node] and stem is None:
                stem = self.stem[node]
        return self._state(new, swapped, stem)

    def match(self, word: str):
        if len(self.states) > STATES:
            self._forget()
        state, moves = self.start, self.moves
        if state < 0:
            return None
        for ch in word:
            after = moves[state].get(ch)
            if after is None:
                after = moves[state][ch] = self._move(state, ch)
            if after < 0:
                return None
            state = after
        found = self.accepts[state]
        return None if found and found[1] and word in self.clean else found
