"""Generalised LR repair of a sequence of roles.

An SLR(1) table is built from the role grammar. A stack is a chain of states; the
stacks alive after each turn form a graph, whose nodes are (turn, stack top) with
one link back to the best predecessor: equal tops are merged, keeping the minimum
by (cost, audit). A turn may be kept, reroled or deleted, with any symbols
inserted before it.

Audits are never compared as text. The stacks of one turn are ranked by their
audits: two audits that both end with the same turn's own edit are never a
prefix of each other, so the parent's rank, then the last step's letters, decide.
Runs can start from any stack top, so a long conversation is cut into chunks
whose (entry top, exit top) tables of cost and rank are combined in order.
"""

from __future__ import annotations

from functools import lru_cache

# The rules of a conversation: nothing, or an optional system turn before user/assistant pairs.
GRAMMAR = [("C", ""), ("C", "HP"), ("H", ""), ("H", "s"), ("P", "Q"), ("P", "PQ"), ("Q", "ua")]
NAMES = {"u": "user", "a": "assistant"}           # what a turn may be reroled to or inserted as
RESTORE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
OK, CUT, BLANK, SEEN = range(4)                   # a turn's fault
INITIALS = "suax"                                 # x: any other role
END = "$"


def slr(grammar) -> tuple[list[dict], list[dict]]:
    """(actions, gotos) by state: a symbol's action is the list of moves the
    table allows, ("shift", state), ("reduce", rule) or ("accept",)."""
    left = {a for a, _ in grammar}
    rules = [("^", grammar[0][0]), *grammar]

    def closure(items):
        todo, seen = list(items), set(items)
        while todo:
            r, dot = todo.pop()
            after = rules[r][1][dot:dot + 1]
            for i, (a, _) in enumerate(rules):
                if a == after and (i, 0) not in seen:
                    seen.add((i, 0))
                    todo.append((i, 0))
        return frozenset(seen)

    empty, first, follow = set(), {a: set() for a in left}, {a: set() for a in left | {"^"}}
    follow["^"].add(END)
    while True:                                   # empty symbols, first and follow sets to their fixed point
        before = (len(empty), sum(map(len, first.values())), sum(map(len, follow.values())))
        for a, body in rules:
            if a != "^" and all(x in empty for x in body):
                empty.add(a)
            for x in body if a != "^" else "":
                first[a] |= first.get(x, {x})
                if x not in empty:
                    break
            tail = set(follow[a])
            for x in reversed(body):
                if x in left:
                    follow[x] |= tail
                tail = first.get(x, {x}) | (tail if x in empty else set())
        if before == (len(empty), sum(map(len, first.values())), sum(map(len, follow.values()))):
            break

    states, actions, gotos = [closure({(0, 0)})], [], []
    for at in states:                             # grows while it is walked
        act, to = {}, {}
        for x in sorted({rules[r][1][dot] for r, dot in at if dot < len(rules[r][1])}):
            new = closure({(r, dot + 1) for r, dot in at if rules[r][1][dot:dot + 1] == x})
            if new not in states:
                states.append(new)
            if x in left:
                to[x] = states.index(new)
            else:
                act.setdefault(x, []).append(("shift", states.index(new)))
        for r, dot in sorted(at):
            if dot == len(rules[r][1]):
                for x in [END] if r == 0 else sorted(follow[rules[r][0]]):
                    act.setdefault(x, []).append(("accept",) if r == 0 else ("reduce", r - 1))
        actions.append(act)
        gotos.append(to)
    return actions, gotos


class Repair:
    """The compiled grammar: stack tops after a shift, and the cheapest step
    between each two of them for every kind of turn."""

    def __init__(self, grammar=None):
        self.grammar = grammar or GRAMMAR
        self.actions, self.gotos = slr(self.grammar)
        self.stacks = {0: (0,)}                   # a stack of each top
        todo = [0]
        while todo:
            top = todo.pop(0)
            for x in INITIALS[:3]:
                for new in self.shift(self.stacks[top], x):
                    if new[-1] not in self.stacks:
                        self.stacks[new[-1]] = new
                        todo.append(new[-1])
        self.tops = list(self.stacks)
        self.move = [{x: [self.tops.index(new[-1]) for new in self.shift(self.stacks[t], x)] for x in INITIALS[:3]} for t in self.tops]
        done = [bool(self.shift(self.stacks[t], END)) for t in self.tops]
        self.reach = [self._inserted(t) for t in range(len(self.tops))]
        # fewest insertions to an accepting top
        self.closing = [min((v for v in ((len(p), p) for u, p in r.items() if done[u])), default=None) for r in self.reach]
        self.steps = [[self._step(t, role, fault) for t in range(len(self.tops))] for role in INITIALS for fault in range(4)]

    def shift(self, stack: tuple, symbol: str) -> list[tuple]:
        """The stacks after the reductions that ``symbol`` calls for and its
        shift; for the end mark, the accepted stacks."""
        out, todo = [], [stack]
        while todo:
            s = todo.pop()
            for act in self.actions[s[-1]].get(symbol, ()):
                if act[0] == "reduce":
                    a, body = self.grammar[act[1]]
                    base = s[:len(s) - len(body)]
                    todo.append((*base, self.gotos[base[-1]][a]))
                else:
                    out.append(s if act[0] == "accept" else (*s, act[1]))
        return out

    def _inserted(self, t: int) -> dict[int, str]:
        """top -> fewest symbols to insert from t."""
        found, todo = {t: ""}, [t]
        while todo:
            at = todo.pop(0)
            for x in NAMES:
                for new in self.move[at][x]:
                    if new not in found:
                        found[new] = found[at] + x
                        todo.append(new)
        return found

    def _step(self, t: int, role: str, fault: int) -> dict[int, tuple[int, str, str]]:
        """exit top -> (cost, letters, symbols put out) of the least step from t
        over one turn; a deleted turn puts out nothing."""
        best: dict[int, tuple[int, str, str]] = {}

        def offer(top, cost, letters, symbols):
            if top not in best or (cost, letters) < best[top][:2]:
                best[top] = (cost, letters, symbols)

        for at, ins in self.reach[t].items():
            cost, letters = INSERT * len(ins), "I" * len(ins)
            offer(at, cost + DELETE, letters + "D", ins)
            if fault in (OK, CUT):
                for x in INITIALS[:3]:
                    for new in self.move[at][x]:
                        extra = TRUNCATED * (fault == CUT)
                        if x == role:
                            offer(new, cost + extra, letters + "K", ins + x)
                        if x in NAMES:
                            offer(new, cost + extra + RESTORE, letters + "R", ins + x)
        return best

    def run(self, codes: str, entry: int):
        """Over the turns ``codes`` (hex digits: role * 4 + fault) from stack top
        ``entry``: (exit top -> (cost, rank), one bytes per turn of the parent tops)."""
        front, back, width = {entry: (0, 0)}, [], len(self.tops)
        for c in codes:
            steps, best = self.steps[int(c, 16)], {}
            for t, (cost, rank) in front.items():
                for top, (more, letters, _) in steps[t].items():
                    new = (cost + more, rank, letters, t)
                    if top not in best or new < best[top]:
                        best[top] = new
            order = {v: i for i, v in enumerate(sorted({(rank, letters) for _, rank, letters, _ in best.values()}))}
            front = {top: (cost, order[rank, letters]) for top, (cost, rank, letters, _) in best.items()}
            back.append(bytes(best[t][3] if t in best else 255 for t in range(width)))
        return front, back

    def table(self, codes: str) -> list[dict[int, tuple[int, int]]]:
        """``run``'s exits for every entry top."""
        return [self.run(codes, t)[0] for t in range(len(self.tops))]

    def choose(self, tables) -> tuple[int, list[tuple[int, int]], str]:
        """For the tables of a conversation's chunks in order: (cost, (entry, exit)
        of each chunk, symbols inserted at the end)."""
        front, back = {0: (0, 0)}, []
        for table in tables:
            best = {}
            for t, (cost, rank) in front.items():
                for top, (more, r) in table[t].items():
                    new = (cost + more, rank, r, t)
                    if top not in best or new < best[top]:
                        best[top] = new
            order = {v: i for i, v in enumerate(sorted({v[1:3] for v in best.values()}))}
            front = {top: (v[0], order[v[1:3]]) for top, v in best.items()}
            back.append({top: v[3] for top, v in best.items()})
        cost, _, top = min((cost + INSERT * self.closing[t][0], rank, t) for t, (cost, rank) in front.items() if self.closing[t] is not None)
        closing, path = self.closing[top][1], []
        for links in reversed(back):
            path.append((links[top], top))
            top = links[top]
        return cost, path[::-1], closing

    def edits(self, codes: str, entry: int, out: int) -> list[tuple[str, int, str | None]]:
        """(letter, turn it acts on or -1, new role or None) in order, from one
        stack top to the other."""
        _, back = self.run(codes, entry)
        path, top = [], out
        for i in range(len(codes) - 1, -1, -1):
            parent = back[i][top]
            path.append((i, *self.steps[int(codes[i], 16)][parent][top][1:]))
            top = parent
        found = []
        for i, letters, symbols in reversed(path):
            found += [("I", -1, NAMES[x]) for x in symbols[:len(letters) - 1]]
            last = letters[-1]
            found.append((last, i, NAMES[symbols[-1]] if last == "R" else None))
        return found


def cached(repair: Repair, short: int = 64):
    """``table`` and ``edits`` that remember short turn sequences, which recur."""
    table, edits = lru_cache(1 << 14)(repair.table), lru_cache(1 << 14)(repair.edits)
    return (lambda c: table(c) if len(c) <= short else repair.table(c)), \
        (lambda c, a, b: edits(c, a, b) if len(c) <= short else repair.edits(c, a, b))
