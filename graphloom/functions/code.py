"""Source texts to chunks: by symbol for Python, by window for the rest."""

from __future__ import annotations

import ast

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

CHUNK = ArrayType(StructType([StructField("symbol", StringType()), StructField("start_line", IntegerType()), StructField("end_line", IntegerType()), StructField("text", StringType())]))
#: Letters of a chunk of code and what neighbours share; and of other texts.
CODE, OTHER = (4000, 400), (1500, 200)


def windows(text: str, size: int, overlap: int) -> list[tuple[int, str]]:
    """(offset, part) of overlapping windows, up to the one that reaches the end."""
    starts = range(0, max(1, len(text) - overlap), size - overlap)
    return [(o, text[o : o + size]) for o in starts if text[o : o + size]]


def symbols(source: str) -> list[tuple[str, int, int]]:
    """(symbol, first line, last line) of functions, classes, and runs of module code between them.

    A class too large for one chunk is given by its methods and what stands between them.
    """
    lines = source.split("\n")
    length = lambda a, z: sum(len(x) + 1 for x in lines[a - 1 : z])
    out: list[tuple[str, int, int]] = []

    def cut(body: list, first: int, last: int, prefix: str) -> None:
        at = first
        for node in body:
            if not isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)):
                continue
            begin = min([node.lineno, *[d.lineno for d in node.decorator_list]])
            if begin > at and any(x.strip() for x in lines[at - 1 : begin - 1]):
                out.append((prefix or "<module>", at, begin - 1))
            name = f"{prefix}.{node.name}" if prefix else node.name
            if isinstance(node, ast.ClassDef) and length(begin, node.end_lineno) > CODE[0]:
                cut(node.body, begin, node.end_lineno, name)
            else:
                out.append((name, begin, node.end_lineno))
            at = node.end_lineno + 1
        if at <= last and any(x.strip() for x in lines[at - 1 : last]):
            out.append((prefix or "<module>", at, last))

    cut(ast.parse(source).body, 1, len(lines), "")
    return out


@F.udf(returnType=CHUNK, useArrow=True)
def code_chunks(path, text):
    """Chunks of a file: Python by symbol, long symbols in windows that keep their name; all else by window."""
    if not text:
        return []
    try:
        found = symbols(text) if path.endswith(".py") else []
    except (SyntaxError, ValueError):
        found = []
    lines, out = text.split("\n"), []
    size, overlap = CODE if found else OTHER
    for symbol, first, last in found or [("", 1, len(lines))]:
        whole = "\n".join(lines[first - 1 : last])
        for offset, part in windows(whole, size, overlap):
            begin = first + whole.count("\n", 0, offset)
            out.append({"symbol": symbol, "start_line": begin, "end_line": begin + part.count("\n"), "text": part})
    return out


def file_chunks(files: DataFrame) -> DataFrame:
    """path, idx, symbol, lines and text of the chunks of files (path, text)."""
    return files.select("path", F.posexplode(code_chunks("path", "text")).alias("idx", "c")).select("path", "idx", "c.*")
