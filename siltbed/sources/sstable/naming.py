"""What a file's name and folder say: version, keyspace, table."""

from __future__ import annotations

import re
from dataclasses import dataclass

from siltbed.functions.scalars import NEW_NAME, OLD_NAME

DATA = "-Data.db"


def version(letters: str) -> int:
    """Two letters as a number that orders versions; one letter counts as if followed by a."""
    first, second = (letters + "a")[:2]
    return (ord(first) - 97) * 26 + ord(second) - 97


#: Versions at which the layout changes.
D, HC, HD, IB, JA, JB, KA, LA, MA = (version(x) for x in ("d", "hc", "hd", "ib", "ja", "jb", "ka", "la", "ma"))


@dataclass(frozen=True)
class Table:
    """One data file: ``stem`` is its path without ``-Data.db``."""

    stem: str
    version: int
    keyspace: str
    table: str


def parse(path: str, strip_id: bool = False) -> Table:
    """Keyspace and table come from the name before version la, from the last two folders since; ``strip_id`` takes a
    trailing id off the folder's name."""
    folders, _, name = path.rpartition("/")
    if m := re.search(NEW_NAME, name):
        above = folders.split("/")
        if len(above) < 2 or not above[-2]:
            raise ValueError(f"no keyspace and table folder above {path}")
        table = re.sub(r"-[0-9a-f]{32}$", "", above[-1]) if strip_id else above[-1]
        return Table(path[: -len(DATA)], version(m[1]), above[-2], table)
    if m := re.search(OLD_NAME, name):
        return Table(path[: -len(DATA)], version(m[3]), m[1], m[2])
    raise ValueError(f"not the name of a data file: {path}")
