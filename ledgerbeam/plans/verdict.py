"""Exit codes and the order in which failures take precedence."""

from __future__ import annotations

from enum import IntEnum
from typing import NamedTuple


class Code(IntEnum):
    """What a run ends with (fixed values)."""

    OK = 0
    USAGE = 2
    LISTS = 3
    FILES = 4
    NOTHING = 5
    DISAGREE = 6
    DUPLICATES = 7
    INVARIANT = 8
    DOMAIN = 9
    READ = 10


class Refused(Exception):
    """A run that stops with a code."""

    def __init__(self, code: int, why: str):
        super().__init__(f"{why} (exit {int(code)})")
        self.code, self.why = int(code), why


class Verdict(NamedTuple):
    code: int
    failed: str | None
    counters: dict

    @property
    def passed(self) -> bool:
        return self.code == 0


def decide(counters: dict, checks: list[tuple[int, str, str]]) -> Verdict:
    """The first failing check of (code, counter, 'zero' or 'positive'); all counters come along in any case."""
    for code, name, want in checks:
        value = counters.get(name)
        if value is None or (value != 0 if want == "zero" else not value > 0):
            return Verdict(int(code), name, counters)
    return Verdict(0, None, counters)


#: In-memory matcher: domain, duplicates, nothing matched, disagreement, invariants.
AUDIT = [
    (Code.DOMAIN, "run_not_1", "zero"), (Code.DUPLICATES, "n_dup", "zero"), (Code.NOTHING, "matched", "positive"), (Code.DISAGREE, "disagree", "zero"),
    *((Code.INVARIANT, x, "zero") for x in ("viol_ext_but_lt3", "viol_ge3_not_ext", "viol_prefix_changed", "viol_wrong_sub", "viol_unchanged")),
]
#: Sorted matcher: no duplicate and no exact-mapping check, but conservation.
SORTED_AUDIT = [
    (Code.DOMAIN, "run_not_1", "zero"), (Code.NOTHING, "matched", "positive"), (Code.DISAGREE, "disagree", "zero"),
    *((Code.INVARIANT, x, "zero") for x in ("viol_ext_but_lt3", "viol_ge3_not_ext", "viol_prefix_changed", "viol_le2_changed", "not_conserved")),
]
