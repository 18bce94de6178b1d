"""Cheapest edits of a row sequence into legal turns, with edit texts kept as persistent linked nodes.

A state is what the kept roles so far allow next. For every state one text of edit
initials is kept: the cheapest, of equal cost the least in ASCII order. Texts share
their beginnings: a text is a node with a link to the node before its last letter,
a binary-lifting link further back and a rolling hash of the whole text. Two texts
of equal cost are compared at the end of their longest common prefix, which is
searched along these links by hashes. A hash only proposes that two prefixes are
alike; where they are different nodes their letters are read.
"""

from __future__ import annotations

#: States: nothing kept yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
#: The state that a turn of a given initial leads to; absent where the turn is illegal.
LEGAL = {
    (START, "s"): SYSTEM,
    (START, "u"): USER,
    (SYSTEM, "u"): USER,
    (ASSISTANT, "u"): USER,
    (USER, "a"): ASSISTANT,
}
#: The state after a turn whose role may be chosen: user, or assistant after a user.
CHOSEN = (USER, USER, ASSISTANT, USER)
#: States in which a conversation may end.
ENDS = (START, ASSISTANT)
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
PRIME, BASE = (1 << 61) - 1, 1_000_003


class Texts:
    """Texts that share beginnings; node 0 is the empty one."""

    def __init__(self):
        self.before, self.back, self.depth, self.letter, self.hash = [0], [0], [0], [""], [0]

    def add(self, node: int, letter: str) -> int:
        """The node of ``node``'s text and one more letter."""
        back, depth = self.back, self.depth
        far = back[node]
        # The farther link spans two equal spans of the node before, so links of equal depth reach equally far.
        jump = back[far] if depth[node] - depth[far] == depth[far] - depth[back[far]] and node else node
        self.before.append(node)
        back.append(jump)
        depth.append(depth[node] + 1)
        self.letter.append(letter)
        self.hash.append((self.hash[node] * BASE + ord(letter)) % PRIME)
        return len(depth) - 1

    def cut(self, node: int, depth: int) -> int:
        """The node of the first ``depth`` letters."""
        while self.depth[node] > depth:
            far = self.back[node]
            node = far if self.depth[far] >= depth else self.before[node]
        return node

    def parted(self, a: int, b: int) -> tuple[int, int]:
        """The first nodes in which two texts of equal depth differ; the same node twice if they do not."""
        if a == b:
            return a, b
        found = a, a
        if self.hash[a] != self.hash[b]:
            while True:
                far, other = self.back[a], self.back[b]
                if self.hash[far] != self.hash[other]:
                    a, b = far, other
                    continue
                found = a, b
                a, b = self.before[a], self.before[b]
                if self.hash[a] == self.hash[b]:
                    break
        # What is alike by hash only is read back to the node that both share.
        while a != b:
            if self.letter[a] != self.letter[b]:
                found = a, b
            a, b = self.before[a], self.before[b]
        return found

    def less(self, a: int, b: int) -> bool:
        """Whether text ``a`` comes before text ``b`` in ASCII order."""
        depth = min(self.depth[a], self.depth[b])
        one, two = self.parted(self.cut(a, depth), self.cut(b, depth))
        if one == two:
            return self.depth[a] < self.depth[b]
        return self.letter[one] < self.letter[two]

    def text(self, node: int) -> str:
        letters = []
        while node:
            letters.append(self.letter[node])
            node = self.before[node]
        return "".join(reversed(letters))


class Edits:
    """The best edits of the rows read so far, from one state to every state."""

    def __init__(self, start: int = START):
        self.texts = Texts()
        self.best: list[tuple[int, int] | None] = [None] * STATES
        self.best[start] = (0, 0)
        self.insert()

    def better(self, now: tuple[int, int] | None, cost: int, node: int, letter: str) -> tuple[int, int]:
        if now is not None and now[0] < cost:
            return now
        new = cost, self.texts.add(node, letter)
        return new if now is None or cost < now[0] or self.texts.less(new[1], now[1]) else now

    def insert(self) -> None:
        """Empty turns after the last row: one or two, as more lead back to a state for a higher cost."""
        best = self.best
        for target, sources in ((USER, (START, SYSTEM, ASSISTANT)), (ASSISTANT, (USER,))):
            for source in sources:
                if best[source] is not None:
                    cost, node = best[source]
                    best[target] = self.better(best[target], cost + INSERT, node, "I")

    def read(self, initial: str, gone: bool, cut_off: bool) -> None:
        """One row: its role's initial, whether it must be deleted, whether its text breaks off."""
        new: list[tuple[int, int] | None] = [None] * STATES
        stays = CUT_OFF if cut_off else 0
        for state, held in enumerate(self.best):
            if held is None:
                continue
            cost, node = held
            new[state] = self.better(new[state], cost + DELETE, node, "D")
            if gone:
                continue
            target = LEGAL.get((state, initial))
            if target is not None:
                new[target] = self.better(new[target], cost + KEEP + stays, node, "K")
            target = CHOSEN[state]
            new[target] = self.better(new[target], cost + REROLE + stays, node, "R")
        self.best = new
        self.insert()

    def told(self) -> list[tuple[int, str] | None]:
        """Cost and text for every state that can be reached."""
        return [None if held is None else (held[0], self.texts.text(held[1])) for held in self.best]


class Joined:
    """The best edits of a sequence from those of its consecutive parts.

    A part has, for every state before and after it, its best cost and text.
    Texts are links to the text before and a piece; two of equal cost are compared
    in the pieces behind the last link that they share.
    """

    def __init__(self):
        self.now: list[tuple[int, tuple] | None] = [None] * STATES
        self.now[START] = (0, ())

    def add(self, part: list[list[tuple[int, str] | None]]) -> None:
        new: list[tuple[int, tuple] | None] = [None] * STATES
        for held, steps in zip(self.now, part):
            for target, step in enumerate(steps):
                if held is not None and step is not None:
                    new[target] = self.better(new[target], (held[0] + step[0], (held[1], step[1])))
        self.now = new

    @staticmethod
    def better(now: tuple[int, tuple] | None, other: tuple[int, tuple]) -> tuple[int, tuple]:
        if now is None or other[0] < now[0] or (other[0] == now[0] and _less(other[1], now[1])):
            return other
        return now

    def end(self) -> tuple[int, str]:
        best = None
        for state in ENDS:
            if self.now[state] is not None:
                best = self.better(best, self.now[state])
        return best[0], "".join(_pieces(best[1], None))


def _pieces(link: tuple, shared: tuple | None) -> list[str]:
    out = []
    while link and link is not shared:
        out.append(link[1])
        link = link[0]
    return out[::-1]


def _less(a: tuple, b: tuple) -> bool:
    x, y = a, b
    while x is not y and x and y:
        x, y = x[0], y[0]
    return "".join(_pieces(a, x)) < "".join(_pieces(b, y))
