"""Technical column names. Only metadata is touched here; no job runs."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable

_WORD = re.compile(r"[A-Za-z0-9]+")


class NameCollision(ValueError):
    """Two source columns would end up under one technical name."""


def technical_name(name: str) -> str:
    """The ASCII letter-and-digit runs of ``name`` joined by single underscores."""
    return "_".join(_WORD.findall(name))


def technical_names(names: Iterable[str]) -> dict[str, str]:
    """Original name -> technical name, refusing empty and colliding results.

    Spark resolves names without regard to case, so the comparison does too.
    """
    names = list(names)
    renamed = [(name, technical_name(name)) for name in names]
    empty = [name for name, new in renamed if not new]
    if empty:
        raise ValueError(f"no letter or digit left in column names {empty}")
    originals = defaultdict(list)
    for name, new in renamed:
        originals[new.lower()].append(name)
    clashes = {new: olds for new, olds in originals.items() if len(olds) > 1}
    if clashes:
        raise NameCollision(f"columns collide after renaming: {clashes}")
    return dict(renamed)


def resolve(available: Iterable[str], wanted: Iterable[str]) -> dict[str, str]:
    """Wanted name -> available name, by exact match first, then by technical name.

    Like Spark, the second look disregards case. All unknown names are reported in one
    error; an ambiguous one is an error as well.
    """
    available = list(available)
    by_technical = defaultdict(list)
    for name in available:
        by_technical[technical_name(name).lower()].append(name)
    found, missing = {}, []
    for name in wanted:
        if name in available:
            found[name] = name
            continue
        candidates = by_technical.get(technical_name(name).lower(), [])
        if len(candidates) > 1:
            raise NameCollision(f"{name!r} may mean any of {candidates}")
        if candidates:
            found[name] = candidates[0]
        else:
            missing.append(name)
    if missing:
        raise ValueError(f"columns not found: {missing}; available: {available}")
    return found


def quoted(name: str) -> str:
    """``name`` as one identifier, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"
