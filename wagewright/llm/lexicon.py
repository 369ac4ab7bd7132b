"""A lexicon trie that reads misspelled words."""

from __future__ import annotations

# Digits that stand for letters.
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t"}

#: Bytes, about, of remembered words, and remembered steps of the automaton (some 150 bytes each).
WORDS, MOVES = 24_000_000, 400_000


def allowed(term: str) -> int:
    """Edits that a whole term may differ by; short words differ by one edit from too many others."""
    return 0 if len(term) < 5 else 1 if len(term) < 8 else 2


class Lexicon:
    """Terms in a trie, read through a Levenshtein automaton.

    A state is the set of trie nodes a prefix of the word can stand for, each with the fewest edits that get there.
    States and their transitions are made when a word first needs them, so after a while a word costs one look-up
    per character and most words end in the dead state after a few.
    """

    def __init__(self, terms: dict[str, float], stems: dict[str, float]):
        self.child: list[dict[str, int]] = [{}]
        self.budget = [0]
        self.whole: dict[int, tuple[float, int]] = {}
        self.stem: dict[int, float] = {}
        for term, weight in terms.items():
            self.whole[self._insert(term, allowed(term))] = (weight, allowed(term))
        for term, weight in stems.items():
            self.stem[self._insert(term, 0)] = weight
        self.sets: list[tuple[tuple[int, int], ...]] = []
        self.number: dict[tuple[tuple[int, int], ...], int] = {}
        self.move: list[dict[str, int]] = []
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        self.start = self._state({0: 0})
        self.known: dict[str, tuple[float, float, float] | None] = {}
        self.words = self.moves = 0

    def _insert(self, term: str, budget: int) -> int:
        node = 0
        self.budget[0] = max(self.budget[0], budget)
        for c in term:
            if c not in self.child[node]:
                self.child[node][c] = len(self.child)
                self.child.append({})
                self.budget.append(0)
            node = self.child[node][c]
            self.budget[node] = max(self.budget[node], budget)
        return node

    def _state(self, found: dict[int, int]) -> int:
        """Close over letters the word leaves out, drop nodes no term below can pay for, and number the set."""
        queue = list(found.items())
        while queue:
            node, edits = queue.pop()
            for below in self.child[node].values():
                if edits + 1 <= self.budget[below] and edits + 1 < found.get(below, 99):
                    found[below] = edits + 1
                    queue.append((below, edits + 1))
        pairs = self.pairs  # the same few pairs stand in very many states
        key = tuple(sorted(pairs.setdefault(p, p) for p in found.items() if p[1] <= self.budget[p[0]]))
        if key not in self.number:
            self.number[key] = len(self.sets)
            self.sets.append(key)
            self.move.append({})
        return self.number[key]

    def _step(self, state: int, c: str) -> int:
        same = {c, LEET.get(c, c)}
        found: dict[int, int] = {}
        for node, edits in self.sets[state]:
            if edits + 1 < found.get(node, 99):  # a letter too many
                found[node] = edits + 1
            for letter, below in self.child[node].items():
                cost = edits + (letter not in same)
                if cost < found.get(below, 99):
                    found[below] = cost
        self.move[state][c] = made = self._state(found)
        self.moves += 1
        return made

    def _forget(self) -> None:
        """Drop what was remembered, so that a worker's memory doesn't grow with the words it meets."""
        self.known.clear()
        self.words = 0
        if self.moves > MOVES:
            self.sets, self.number, self.move, self.moves = [], {}, [], 0
            self.start = self._state({0: 0})

    def read(self, word: str) -> tuple[float, float, float] | None:
        """Weight of the word as a term, as a misspelled term and by its stem; None for most words."""
        known = self.known
        if word in known:
            return known[word]
        self.words += len(word) + 100
        if self.words > WORDS or self.moves > MOVES:
            self._forget()
        state, move, stem = self.start, self.move, 0.0
        sets, stems = self.sets, self.stem
        for c in word:
            after = move[state].get(c)
            state = self._step(state, c) if after is None else after
            if not sets[state]:
                break
            for node, edits in sets[state]:
                if not edits and node in stems and stems[node] > stem:
                    stem = stems[node]
        exact = fuzzy = 0.0
        for node, edits in sets[state]:
            if node in self.whole and edits <= self.whole[node][1]:
                if edits:
                    fuzzy = max(fuzzy, self.whole[node][0])
                else:
                    exact = max(exact, self.whole[node][0])
        known[word] = (exact, 0.0 if exact else fuzzy, stem) if exact or fuzzy or stem else None
        return known[word]
