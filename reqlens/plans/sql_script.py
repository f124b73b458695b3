"""Run the statements of a SQL file over the transformed layer.

A script is SQL text with statements ended by ``;``.  Semicolons inside quotes (single, double or
back quotes) and comments (``--`` to the end of the line, ``/* */``, nested too) end nothing.  A comment
``-- title: ...`` names the statement that follows.  Statements run in order, so a script may define functions or
views for its later statements; each one that gives columns comes back as a lazy DataFrame.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from pathlib import Path
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

#: The nine analyses (and row count and sample) as statements over the view ``requests``.
ANALYSES_SQL = Path(__file__).with_name("analyses.sql")

_TOKEN = re.compile(
    r"""(?P<line>--[^\n]*)|(?P<open>/\*)|(?P<quoted>'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.|"")*"|`(?:[^`]|``)*`)|(?P<end>;)""", re.DOTALL
)
_TITLE = re.compile(r"--\s*title:\s*(.+?)\s*$")


class Statement(NamedTuple):
    title: str
    text: str


def _comment_end(text: str, at: int) -> int:
    """Where the bracketed comment that opens at ``at`` ends; comments nest."""
    depth = 0
    for m in re.finditer(r"/\*|\*/", text[at:]):
        depth += 1 if m.group() == "/*" else -1
        if not depth:
            return at + m.end()
    return len(text)


def read_statements(script: str) -> list[Statement]:
    """The statements of ``script`` without their comments; those that are empty then are none."""
    found, parts, title, at = [], [], None, 0

    def close() -> None:
        text = "".join(parts).strip()
        if text:
            found.append(Statement(title or f"Statement {len(found) + 1}", text))
        parts.clear()

    while m := _TOKEN.search(script, at):
        parts.append(script[at : m.start()])
        at = m.end()
        if m["line"]:
            named = _TITLE.match(m["line"])
            title = named[1] if named else title
            parts.append(" ")
        elif m["open"]:
            at = _comment_end(script, m.start())
            parts.append(" ")
        elif m["quoted"]:
            parts.append(m["quoted"])
        else:
            close()
            title = None
    parts.append(script[at:])
    close()
    return found


def run_script(spark: SparkSession, script: str, views: Mapping[str, DataFrame] | None = None) -> list[tuple[str, DataFrame]]:
    """(title, DataFrame) of each statement of ``script`` that gives columns, with ``views`` as temporary views."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    results = [(s.title, spark.sql(s.text)) for s in read_statements(script)]
    return [(title, df) for title, df in results if df.columns]
