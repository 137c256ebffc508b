"""Plain text of wiki markup whose constructs stand in one another.

Templates, tables, links, references and comments nest to any depth, which no regular
expression follows. One pass over the marks of a text keeps the open constructs on a stack: a
closing mark ends the innermost one of its kind, and with it all that stand open inside.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Opening marks with their closing ones.
CLOSES = {"{{": "}}", "{|": "|}", "[[": "]]", "<ref": "</ref>"}
MARK = re.compile(r"\{\{\{[^{}]*\}\}\}|<!--.*?(?:-->|\Z)|\|\}+|\{\{|\}\}|\{\||\[\[|\]\]|<ref\b[^<>]*/>|<ref\b[^<>]*>|</ref\s*>"
                  r"|\[(?:https?|ftp)://[^\s\]]*[^\S\n]*([^\[\]\n]*)\]|<[^<>]*>|'{2,5}|^=+[^\S\n]*|[^\S\n]*=+[^\S\n]*$|\|",
                  re.S | re.M | re.I)
# A link to a file, a category or another space is no text.
SPACE = re.compile(r"\s*:?[^\W\d_]+:", re.U)


def plain_text(markup: str) -> str:
    """The visible text: templates, tables, references, comments and tags go, links leave their
    label (or their target, without one), marks of emphasis and headings go, runs of blanks
    become one. A construct that is never closed, and a closing mark that nothing opened, lose
    their mark only: no text is lost to a missing mark."""
    # (opening mark, parts since, place of the first part after its last bar)
    open_: list[tuple[str, list[str], list[int]]] = [("", [], [])]

    def close(depth: int) -> None:
        """End the construct at this depth; what stands open inside was never closed."""
        while len(open_) > depth + 1:
            _, parts, _ = open_.pop()
            open_[-1][1].extend(parts)
        mark, parts, bars = open_.pop()
        if mark == "[[" and not SPACE.match("".join(parts[:bars[0]] if bars else parts)):
            write("".join(parts[bars[-1]:] if bars else parts))

    def write(text: str) -> None:
        if text:
            open_[-1][1].append(text)

    def end(kind: str) -> None:
        """The innermost construct that this mark closes, if there is one."""
        depth = next((d for d in range(len(open_) - 1, 0, -1) if CLOSES[open_[d][0]] == kind), 0)
        if depth:
            close(depth)

    at = 0
    for m in MARK.finditer(markup):
        write(markup[at:m.start()])
        at, mark = m.end(), m.group()
        if mark.startswith("|}"):
            # the end of a table if one is the innermost, or a bar; then ends of templates
            braces = len(mark) - 1
            if next((o[0] for o in reversed(open_) if o[0] in ("{{", "{|")), "") == "{|" or braces == 1:
                end("|}")
                braces -= 1
            for _ in range(braces // 2):
                end("}}")
            write("}" * (braces % 2))
            continue
        kind = "<ref" if mark[:4].lower() == "<ref" else "</ref>" if mark[:5].lower() == "</ref" else mark
        if kind == "<ref" and mark.endswith("/>"):
            continue
        if kind in CLOSES:
            open_.append((kind, [], []))
        elif kind in ("}}", "]]", "</ref>"):
            end(kind)
        elif mark.startswith("{{{"):
            continue  # a parameter of a template
        elif mark == "|":
            if open_[-1][0] == "[[":
                open_[-1][2].append(len(open_[-1][1]))
            elif len(open_) == 1:
                write(mark)
        elif m.group(1) is not None:
            write(m.group(1))
        elif mark[0] == "<" and not mark.startswith("<!--"):
            write(" ")
    parts = [p for _, some, _ in open_ for p in some]
    return re.sub(r"\s+", " ", "".join([*parts, markup[at:]])).strip()


def _plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [plain_text(t.as_py()) if t.is_valid else None for t in batch.column(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], batch.schema.names)


def markup_text(df: DataFrame, key: str, markup: str, out: str = "content") -> DataFrame:
    """(key, out): plain text of each row's markup; rows without any give no row."""
    rows = df.select(F.col(key), F.col(markup).alias(out))
    return rows.mapInArrow(_plain, rows.schema).where(F.length(out) > 0)
