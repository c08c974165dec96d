"""Recognition by Tesseract. ``recognize(path)`` yields a dict of parallel word lists per page, ``read_regions(path)`` the texts of regions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from .. import rules, schemas

WORDS = schemas.OCR_WORDS
REGIONS = "file_hash string, page_num int, position int, region string, text string"


def _images(path: str, dpi: int):
    try:
        import io

        import fitz
        from PIL import Image
    except ImportError as e:
        raise RuntimeError("rendering pages needs PyMuPDF and Pillow, which aren't installed") from e
    with fitz.open(path) as doc:
        for page in doc:
            yield Image.open(io.BytesIO(page.get_pixmap(dpi=dpi).tobytes("png")))


def recognize(path: str, dpi: int = 300, language: str = rules.OCR_LANGUAGE) -> Iterator[dict]:
    import pytesseract

    for image in _images(path, dpi):
        data = pytesseract.image_to_data(image, lang=language, output_type=pytesseract.Output.DICT)
        yield {"text": list(data["text"]), "conf": [str(c) for c in data["conf"]]}


def read_regions(path: str, dpi: int = 300, language: str = rules.OCR_LANGUAGE) -> Iterator[list[tuple[str, str]]]:
    import pytesseract
    from PIL import ImageFilter

    for image in _images(path, dpi):
        image = image.convert("L").filter(ImageFilter.SHARPEN)
        width, height = image.size
        yield [(name, pytesseract.image_to_string(image.crop((0, height * a // 8, width, height * b // 8)), lang=language, config=f"--psm {mode}")) for name, a, b, mode in rules.REGIONS]


def words(items: DataFrame, reader: Callable[[str], Iterator[dict]] = recognize) -> DataFrame:
    """``file_hash, page_num, text[], conf[]`` for every page of ``items(file_hash, path)``."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for file_hash, path in zip(pdf["file_hash"], pdf["path"], strict=True):
                for n, page in enumerate(reader(path), 1):
                    yield pd.DataFrame([(file_hash, n, page["text"], page["conf"])], columns=["file_hash", "page_num", "text", "conf"])

    return items.select("file_hash", "path").mapInPandas(run, WORDS)


def regions(items: DataFrame, reader: Callable[[str], Iterator[list[tuple[str, str]]]] = read_regions) -> DataFrame:
    """``file_hash, page_num, position, region, text`` for every region of every page."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for file_hash, path in zip(pdf["file_hash"], pdf["path"], strict=True):
                for n, page in enumerate(reader(path), 1):
                    yield pd.DataFrame([(file_hash, n, k, name, text) for k, (name, text) in enumerate(page)], columns=["file_hash", "page_num", "position", "region", "text"])

    return items.select("file_hash", "path").mapInPandas(run, REGIONS)
