"""Tables of HTML pages: only a parser can find them, so this is Arrow-batched Python; what follows is SQL."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sections, the headings that open them, and how many characters each may take.
SECTIONS = {
    "income": ("income statement|statements? of (?:operations|income|earnings)", 80_000),
    "balance": ("balance sheet|financial position", 80_000),
    "cash": ("cash flow", 80_000),
    "segments": ("segment", 40_000),
}
TOTAL_BUDGET, MAX_STEPS, MIN_NUMERIC_ROWS, MIN_CHARS = 220_000, 50, 2, 50


class _Blocks(HTMLParser):
    """The page as a list of ("text", words) and ("table", rows of cells) in document order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[tuple[str, object]] = []
        self.rows: list[list[str]] | None = None
        self.cell: list[str] | None = None
        self.depth = self.skip = 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "noscript"):
            self.skip += 1
        elif tag == "table":
            self.depth += 1
            if self.depth == 1:
                self.rows = []
        elif self.rows is not None and tag == "tr":
            self.rows.append([])
        elif self.rows is not None and tag in ("td", "th"):
            self.cell = []

    def handle_endtag(self, tag):
        if tag in ("script", "style", "noscript"):
            self.skip = max(0, self.skip - 1)
        elif tag in ("td", "th") and self.cell is not None:
            if not self.rows:
                self.rows = [[]]
            self.rows[-1].append(" ".join("".join(self.cell).split()))
            self.cell = None
        elif tag == "table" and self.depth:
            self.depth -= 1
            if not self.depth:
                self.out.append(("table", [r for r in self.rows or [] if any(r)]))
                self.rows = None

    def handle_data(self, data):
        if self.skip:
            return
        if self.cell is not None:
            self.cell.append(data)
        elif self.rows is None and data.strip():
            self.out.append(("text", " ".join(data.split())))


def grid(rows: list[list[str]]) -> str:
    """a Markdown table; short rows are padded."""
    width = max(map(len, rows), default=0)
    lines = ["| " + " | ".join([*r, *[""] * (width - len(r))]) + " |" for r in rows]
    return "\n".join([*lines[:1], "|" + "---|" * width, *lines[1:]]) if lines else ""


def page_tables(html: str) -> list[tuple[str, int, str, int]]:
    """(section, position, Markdown, numeric rows) of the tables within MAX_STEPS blocks after a section's heading."""
    p = _Blocks()
    p.feed(html or "")
    p.close()
    found = []
    for name, (pattern, _) in SECTIONS.items():
        for i, (kind, content) in enumerate(p.out):
            if kind == "text" and len(content) < 200 and re.search(pattern, content, re.I):
                for j, (k, rows) in enumerate(p.out[i + 1 : i + 1 + MAX_STEPS], i + 1):
                    if k == "table":
                        md, numeric = grid(rows), sum(any(c.isdigit() for c in " ".join(r)) for r in rows)
                        if numeric >= MIN_NUMERIC_ROWS and len(md) > MIN_CHARS:
                            found.append((name, j, md, numeric))
                break
    return found


def statement_tables(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, section, pos, markdown, n_numeric) within each section's budget and the page's total."""
    from ..operators.audit import budget_cut

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = [], []
            for i, page in enumerate(batch.column(html).to_pylist()):
                got = page_tables(page)
                ids += [i] * len(got)
                rows += got
            cols = list(zip(*rows)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(ids, pa.int64())), pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.int32())], names=[key, "section", "pos", "markdown", "n_numeric"])

    kind = pages.schema[key].dataType.simpleString()
    found = pages.select(key, html).mapInArrow(run, f"{key} {kind}, section string, pos int, markdown string, n_numeric int")
    out = found.withColumn("size", F.length("markdown"))
    parts = None
    for name, (_, budget) in SECTIONS.items():
        part = budget_cut(out.where(F.col("section") == name), key, "pos", "size", budget)
        parts = part if parts is None else parts.unionByName(part)
    rank = F.array_position(F.array(*[F.lit(s) for s in SECTIONS]), F.col("section")) * 1_000_000 + F.col("pos")
    parts = parts.withColumns({"size": F.col("taken"), "markdown": F.substring("markdown", F.lit(1), F.col("taken").cast("int")), "rank": rank}).drop("taken")
    return budget_cut(parts, key, "rank", "size", TOTAL_BUDGET).select(key, "section", "pos", "markdown", "n_numeric")
