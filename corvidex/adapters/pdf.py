"""Facts of PDF pages. Any ``opener`` that yields dicts of page facts will do; the default one needs PyMuPDF."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from .. import rules, schemas

Opener = Callable[[str], Iterator[dict]]
_COLUMNS = ["file_hash", "path", "origin", "page_num", "text", "width", "height", "images", "tables", "spans", "error"]


def open_with_pymupdf(path: str) -> Iterator[dict]:
    try:
        import fitz
    except ImportError as e:
        raise RuntimeError("reading PDFs needs PyMuPDF, which isn't installed") from e
    box = lambda b: {"x0": float(b[0]), "y0": float(b[1]), "x1": float(b[2]), "y1": float(b[3])}
    with fitz.open(path) as doc:
        for page in doc:
            text = page.get_text()
            fact = {"text": text, "width": float(page.rect.width), "height": float(page.rect.height), "images": [box(i["bbox"]) for i in page.get_image_info()], "tables": [], "spans": []}
            # A page without text is scanned whatever its tables and fonts: spare the slow searches.
            if len(text.strip()) >= rules.SCANNED_CHARS:
                fact["tables"] = [box(t.bbox) for t in page.find_tables().tables]
                fact["spans"] = [{"size": float(s["size"]), "text": s["text"]} for b in page.get_text("dict")["blocks"] if b["type"] == 0 for line in b["lines"] for s in line["spans"]]
            yield fact


def page_facts(items: DataFrame, opener: Opener = open_with_pymupdf) -> DataFrame:
    """One row per page of ``items(file_hash, path, origin)``; a file that fails is one row with an error, one without pages a row without a page."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for file_hash, path, origin in zip(pdf["file_hash"], pdf["path"], pdf["origin"], strict=True):
                rows = []
                try:
                    for n, fact in enumerate(opener(path), 1):
                        rows.append((file_hash, path, origin, n, fact["text"], fact["width"], fact["height"], fact["images"], fact["tables"], fact["spans"], None))
                except Exception as e:  # the file's failure, not the task's
                    rows = [(file_hash, path, origin, None, None, None, None, None, None, None, str(e) or type(e).__name__)]
                rows = rows or [(file_hash, path, origin, None, None, None, None, None, None, None, None)]
                yield pd.DataFrame(rows, columns=_COLUMNS).astype({"page_num": "Int32"})

    return items.select("file_hash", "path", "origin").mapInPandas(run, schemas.PAGE_FACTS)
