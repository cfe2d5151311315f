"""What the verdicts of a fold's segment need of the state it started from.

A segment of a hot key is folded from an assumed state. While it is, the values that stem from that state are followed:
numbers keep how they came from a field of it, and each comparison narrows the range in which that field may lie without
a changed answer; texts, missing entries and values that reach a message are needed as they were. The summary of a
segment is what it needs and its end state, written in terms of the start. So a start that differs but meets the needs
leaves all verdicts as they are, and the end state follows without folding again (:func:`applied`).
"""

from __future__ import annotations

from typing import Any


class Need:
    """Conditions on the start state. A path is (entry,) or (entry, field)."""

    def __init__(self):
        self.low: dict[tuple, int] = {}
        self.high: dict[tuple, int] = {}
        self.exact: dict[tuple, Any] = {}
        self.kinds: dict[tuple, str] = {}
        self.shapes: dict[str, list[str]] = {}
        self.absent: set[str] = set()
        self.read: list = []  # values handed out for the event at hand

    def fix(self, path: tuple, value: Any) -> None:
        self.exact[path] = value

    def at_least(self, path: tuple, value: int) -> None:
        self.low[path] = max(value, self.low.get(path, value))

    def at_most(self, path: tuple, value: int) -> None:
        self.high[path] = min(value, self.high.get(path, value))

    def fix_read(self) -> None:
        """An event's message was made from what it has read."""
        for value in self.read:
            value.fix()

    def plain(self) -> dict:
        pairs = lambda found: [[list(k), v] for k, v in found.items()]
        return {
            "low": pairs(self.low), "high": pairs(self.high), "exact": pairs(self.exact), "kinds": pairs(self.kinds),
            "shapes": self.shapes, "absent": sorted(self.absent),
        }


class Num(int):
    """A whole number ``sign * field + offset`` of the start state."""

    def __new__(cls, need: Need, path: tuple, value: int, sign: int = 1, offset: int = 0):
        self = super().__new__(cls, value)
        self.need, self.path, self.sign, self.offset, self.value = need, path, sign, offset, value
        return self

    def fix(self) -> int:
        self.need.fix(self.path, (self.value - self.offset) * self.sign)
        return self.value

    def __add__(self, other):
        return Num(self.need, self.path, self.value + int(other), self.sign, self.offset + int(other))

    __radd__ = __add__

    def __sub__(self, other):
        return self + -int(other)

    def __neg__(self):
        return Num(self.need, self.path, -self.value, -self.sign, -self.offset)

    def __rsub__(self, other):
        return -self + int(other)

    def __lt__(self, other):
        bound, below = int(other) - self.offset, self.value < int(other)
        if self.sign > 0:
            self.need.at_most(self.path, bound - 1) if below else self.need.at_least(self.path, bound)
        else:
            self.need.at_least(self.path, 1 - bound) if below else self.need.at_most(self.path, -bound)
        return below

    def __ge__(self, other):
        return not self < other

    def __le__(self, other):
        return self < int(other) + 1

    def __gt__(self, other):
        return not self <= other

    def __eq__(self, other):
        return self.fix() == other

    def __ne__(self, other):
        return self.fix() != other

    def __hash__(self):
        return hash(self.fix())

    def __bool__(self):
        return bool(self.fix())

    def __int__(self):
        return self.fix()

    __index__ = __int__

    def __str__(self):
        return str(self.fix())

    __repr__ = __str__

    def __format__(self, spec):
        return format(self.fix(), spec)


class Text(str):
    """A text of the start state; whoever looks at it needs it as it is, and copying is no look."""

    def fix(self) -> None:
        self.need.fix(self.path, str.__str__(self))

    def __eq__(self, other):
        self.fix()
        return str.__eq__(self, other)

    def __ne__(self, other):
        self.fix()
        return str.__ne__(self, other)

    def __hash__(self):
        self.fix()
        return str.__hash__(self)

    def __format__(self, spec):
        self.fix()
        return str.__format__(self, spec)

    def __str__(self):
        self.fix()
        return str.__str__(self)


class Tracked:
    """A state under a fold that follows what is read of it; what has been written is read back as it is."""

    def __init__(self, start: dict):
        self.start, self.need, self.written, self._given = start, Need(), {}, {}

    def _value(self, path: tuple, value: Any):
        need = self.need
        if isinstance(value, str):
            need.kinds[path] = "str"
            out = Text(value)
            out.need, out.path = need, path
        elif isinstance(value, int) and not isinstance(value, bool):
            need.kinds[path] = "int"
            out = Num(need, path, value)
        else:
            need.fix(path, value)
            return value
        return out

    def _read(self, key: str):
        if key in self.written:
            return self.written[key]
        if key not in self._given:
            value = self.start[key]
            if isinstance(value, dict):
                self.need.shapes[key] = sorted(value)
                self._given[key] = {f: self._value((key, f), v) for f, v in value.items()}
            else:
                self._given[key] = self._value((key,), value)
        given = self._given[key]
        self.need.read += [v for v in (given.values() if isinstance(given, dict) else (given,)) if isinstance(v, Num | Text)]
        return dict(given) if isinstance(given, dict) else given

    def __contains__(self, key: str) -> bool:
        if key in self.written:
            return True
        if key in self.start:
            self._read(key)
            return True
        self.need.absent.add(key)
        return False

    def __getitem__(self, key: str):
        if key not in self:
            raise KeyError(key)
        return self._read(key)

    def get(self, key: str, default=None):
        return self._read(key) if key in self else default

    def update(self, work: dict) -> None:
        self.written.update(work)

    def state(self) -> dict:
        return plain(self.start | self.written)

    def summary(self) -> dict:
        return {"need": self.need.plain(), "end": {k: _written(v) for k, v in self.written.items()}}


def plain(value):
    """``value`` with the numbers and texts that it has now; looking at them so sets no condition."""
    if isinstance(value, Num):
        return value.value
    if isinstance(value, Text):
        return str.__str__(value)
    return {k: plain(v) for k, v in value.items()} if isinstance(value, dict) else value


def _written(value):
    if isinstance(value, Num):
        return ["number", list(value.path), value.sign, value.offset]
    if isinstance(value, Text):
        return ["text", list(value.path)]
    return ["entry", {k: _written(v) for k, v in value.items()}] if isinstance(value, dict) else ["value", value]


_MISSING = object()


def _at(state: dict, path: list):
    value = state.get(path[0], _MISSING)
    if len(path) == 1:
        return value
    return value.get(path[1], _MISSING) if isinstance(value, dict) else _MISSING


def _kind(value) -> str:
    return "int" if isinstance(value, int) and not isinstance(value, bool) else "str" if isinstance(value, str) else ""


def met(need: dict, start: dict) -> bool:
    """Whether a segment with these needs keeps its verdicts when it starts from ``start``."""
    if any(k in start for k in need["absent"]):
        return False
    if any(not isinstance(start.get(k), dict) or sorted(start[k]) != names for k, names in need["shapes"].items()):
        return False
    if any(_kind(_at(start, path)) != kind for path, kind in need["kinds"]):
        return False
    if any(type(found := _at(start, path)) is not type(value) or found != value for path, value in need["exact"]):
        return False
    return all(_at(start, path) >= low for path, low in need["low"]) and all(_at(start, path) <= high for path, high in need["high"])


def applied(end: dict, start: dict) -> dict:
    """The end state of a segment that starts from ``start``. Where its needs are not met this is a guess, in which a
    number that is not there counts as 0 and a text as null."""

    def value(what):
        if what[0] == "number":
            found = _at(start, what[1])
            return what[2] * (found if _kind(found) == "int" else 0) + what[3]
        if what[0] == "text":
            found = _at(start, what[1])
            return found if _kind(found) == "str" else None
        return {k: value(v) for k, v in what[1].items()} if what[0] == "entry" else what[1]

    return start | {k: value(v) for k, v in end.items()}
