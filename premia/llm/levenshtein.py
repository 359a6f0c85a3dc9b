"""Levenshtein automata intersected with a trie."""

from __future__ import annotations


class Trie:
    """Numbered nodes; 0 is the root. ``children[n]``: character to node, ``ends[n]``: the term that ends there, or None."""

    def __init__(self, terms):
        self.children: list = [{}]
        self.ends: list = [None]
        for term in terms:
            node = 0
            for c in term:
                below = self.children[node].get(c)
                if below is None:
                    below = self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append(None)
                node = below
            self.ends[node] = term

    def below(self, node: int, depth: int):
        """(node, depth) of this node and those at most ``depth`` below it."""
        level = [node]
        for d in range(depth + 1):
            yield from ((n, d) for n in level)
            level = [m for n in level for m in self.children[n].values()]


class Automaton:
    """All terms of a trie within ``errors`` insertions, deletions and substitutions of a word.

    It is the intersection of the Levenshtein automata with the trie, determinised lazily: a state is the set of the trie's
    nodes that what was read leads to, each with its least number of errors, and is made when it is first met. So words
    with a common beginning share its work, and a word that is near no term ends after a few characters. The terms'
    characters that a word lacks are counted when the next one matches, or at the end. At ``most`` so many states are kept.
    """

    def __init__(self, errors: int, most: int = 60_000):
        self.errors, self.most = errors, most
        self.trie = None

    def of(self, trie: Trie) -> None:
        self.trie = trie
        #: For every node: character to the (node, characters left out) it may lead to, and the (term, characters left out) near it.
        self.near: list = []
        self.last: list = []
        for node in range(len(trie.children)):
            steps: dict = {}
            for n, left_out in trie.below(node, self.errors):
                for c, child in trie.children[n].items():
                    steps.setdefault(c, []).append((child, left_out))
            self.near.append(steps)
            self.last.append([(trie.ends[n], d) for n, d in trie.below(node, self.errors) if trie.ends[n] is not None])
        self.restart()

    def restart(self) -> None:
        self.known: dict = {}
        self.start = self.state({0: 0})

    def state(self, places: dict) -> tuple | None:
        """(places, moves from here), one object for equal places."""
        if not places:
            return None
        key = frozenset(places.items())
        found = self.known.get(key)
        if found is None:
            found = self.known[key] = (key, {})
        return found

    def move(self, state: tuple, c: str) -> tuple | None:
        errors, near, children, out = self.errors, self.near, self.trie.children, {}
        for node, e in state[0]:
            for child, left_out in near[node].get(c, ()):
                if e + left_out <= errors and e + left_out < out.get(child, 99):
                    out[child] = e + left_out
            if e < errors:
                e += 1
                if e < out.get(node, 99):
                    out[node] = e  # the word has one more
                for child in children[node].values():
                    if e < out.get(child, 99):
                        out[child] = e
        return self.state(out)

    def matches(self, word: str, trie: Trie) -> list:
        """(term, edit distance) for every term within reach, the nearest first."""
        if trie is not self.trie:
            self.of(trie)
        if len(self.known) > self.most:
            self.restart()
        state = self.start
        for c in word:
            moves = state[1]
            if c in moves:
                following = moves[c]
            else:
                following = moves[c] = self.move(state, c)
            if following is None:
                return []
            state = following
        found: dict = {}
        for node, e in state[0]:
            for term, left_out in self.last[node]:
                if e + left_out <= min(self.errors, found.get(term, 99)):
                    found[term] = e + left_out
        return sorted(found.items(), key=lambda x: (x[1], x[0]))
