"""Ordered text rewriting that skips the steps a text cannot match."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Step(NamedTuple):
    """Replace ``pattern`` (Java regex, or plain text if ``literal``).

    ``needs``: substrings of which at least one is part of every match.
    ``hint``: a cheaper Java regex found in every match, tested on the text as
    it was before the first step.  ``near_digits`` is another one, tested on
    the digits of that text and what stands next to them: all it finds has a
    digit, begins at most ``CONTEXT`` characters before its first digit, ends
    at most as many behind its last one and has no longer gap between two.
    ``starts``: the characters a match can begin with, looked for first.
    ``phrases``: the plain texts of which ``pattern`` finds the first listed.
    """

    pattern: str
    replacement: str
    literal: bool = False
    needs: tuple[str, ...] = ()
    hint: str = ""
    near_digits: str = ""
    starts: str = ""
    phrases: tuple[str, ...] = ()


class Group(NamedTuple):
    """Steps that only texts with a match of ``test`` (Java regex) run at all; ``starts`` as in :class:`Step`."""

    test: str
    steps: tuple[Step, ...]
    starts: str = ""


#: characters kept on both sides of digits, see :func:`around_digits`
CONTEXT = 8
_FAR_FROM_DIGITS = rf"(?U)(\D{{{CONTEXT}}})\D{{{CONTEXT},}}(\D{{{CONTEXT}}})"


def java_pattern(pattern: str, dotall: bool = False) -> str:
    """Add the flags under which Java matches like Python on any text.

    ``U`` makes ``\\w``, ``\\d``, ``\\s`` and ``\\b`` Unicode-aware, ``d`` makes
    the line feed the only line end.
    """
    return ("(?Uds)" if dotall else "(?Ud)") + pattern


def order_matters(earlier: str, later: str) -> bool:
    """Whether ``later`` can begin in front of ``earlier`` and overlap it.

    Only then does replacing one phrase after the other differ from replacing
    whichever comes first in the text.
    """
    return any(
        later[i:].startswith(earlier) or earlier.startswith(later[i:])
        for i in range(1, len(later))
    )


def _looking_ahead(pattern: str, starts: str) -> str:
    return f"(?=[{''.join(map(re.escape, starts))}])(?:{pattern})" if starts else pattern


def apply_step(col: Column, step: Step) -> Column:
    """Replace every match of one step."""
    if step.literal:
        return F.replace(col, F.lit(step.pattern), F.lit(step.replacement))
    pattern = _looking_ahead(step.pattern, step.starts)
    return F.regexp_replace(col, F.lit(pattern), F.lit(step.replacement))


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often it is used.

    The lambda variable also keeps the expression linear in size when the
    optimizer copies it, for instance below a filter.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _hints(step: Step) -> list[tuple[str, bool]]:
    return [hint for hint in ((step.hint, False), (step.near_digits, True)) if hint[0]]


def around_digits(text: Column) -> Column:
    """The digits of a text with at least ``CONTEXT`` characters on both sides; empty without any digit.

    One pass over the text; where digits are rare, tests of the result cost next to nothing.
    """
    return F.when(
        text.rlike(r"(?U)\d"), F.regexp_replace(text, F.lit(_FAR_FROM_DIGITS), F.lit("$1\n$2"))
    ).otherwise("")


def rewrite(col: Column, steps: Iterable[Step | Group]) -> Column:
    """All steps in order; a step runs only on texts it can match."""
    steps = list(steps)
    # (hint, whether it is tested near digits only)
    hints = list(dict.fromkeys(
        hint for step in steps if isinstance(step, Step) for hint in _hints(step)
    ))

    def guarded(step: Step, flags: Column | None) -> Callable[[Column], Column]:
        def run(text: Column) -> Column:
            tests = [flags[hints.index(hint)] for hint in _hints(step)]
            if step.needs:
                found = (F.contains(text, F.lit(n)) for n in step.needs)
                tests.append(reduce(Column.__or__, found))
            test = reduce(Column.__and__, tests)
            return F.when(test, apply_step(text, step)).otherwise(text)

        return run

    def grouped(group: Group) -> Callable[[Column], Column]:
        return lambda text: F.when(
            text.rlike(_looking_ahead(group.test, group.starts)), rewrite(text, group.steps)
        ).otherwise(text)

    def chain(text: Column, flags: Column | None) -> Column:
        for step in steps:
            if isinstance(step, Group):
                text = bind(text, grouped(step))
            elif _hints(step) or step.needs:
                text = bind(text, guarded(step, flags))
            else:
                text = apply_step(text, step)
        return text

    if not hints:
        return chain(col, None)

    def flagged(text: Column, near: Column | None) -> Column:
        found = F.array(*[(near if of_digits else text).rlike(hint) for hint, of_digits in hints])
        return bind(found, lambda flags: chain(text, flags))

    if not any(of_digits for _, of_digits in hints):
        return bind(col, lambda text: flagged(text, None))
    return bind(col, lambda text: bind(around_digits(text), lambda near: flagged(text, near)))


def evaluated_once(col: Column) -> Column:
    """The same value, marked so that no filter above is pushed below it.

    For filters on a costly column, which the optimizer would otherwise
    compute a second time for the pushed-down filter.
    """
    return F.when(F.monotonically_increasing_id() >= 0, col)
