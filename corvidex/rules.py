"""Rule tables and thresholds; every function takes them as parameters with these defaults."""

# Lanes and their extensions, first lane first.
LANES = (
    ("pdf", (".pdf",)),
    ("word_legacy", (".doc",)),
    ("word_modern", (".docx",)),
    ("excel", (".xls", ".xlsx", ".csv")),
    ("slides", (".ppt", ".pptx", ".pps")),
    ("rtf", (".rtf",)),
    ("text", (".txt", ".md")),
    ("image", (".jpg", ".jpeg", ".png", ".tiff")),
    ("audio", (".mp3", ".wav")),
    ("archive", (".rar", ".zip", ".7z")),
    ("database", (".db", ".sqlite")),
)

# Leading bytes in hexadecimal and the extension they stand for, first match first.
MAGIC = (
    ("25504446", ".pdf"),
    ("D0CF11E0A1B11AE1", ".doc"),
    ("504B", ".docx"),
    ("52617221", ".rar"),
    ("53514C69746520666F726D61742033", ".db"),
    ("89504E470D0A1A0A", ".png"),
    ("FFD8", ".jpg"),
    ("494433", ".mp3"),
)

UNKNOWN = "unknown"
NO_EXTENSION = "(no ext)"
TEXT_EXTENSIONS = (".txt", ".csv", ".md")
HEADER_BYTES = 1024
SAMPLE_BYTES = 10_000

# Page classes and their thresholds.
PAGE_CLASSES = ("scanned", "slide_style", "table_heavy", "text_with_tables", "text_structured")
SCANNED_CHARS = 100
SLIDE_IMAGE_RATIO = 0.30
SLIDE_CHARS = 800
SLIDE_HEADINGS = 2
TABLE_RATIO = 0.30
HEADING_FACTOR = 1.25
BACKFILL_CHARS = 10

# Page regions in eighths of the height, with the recognizer's segmentation mode.
REGIONS = (("heading", 0, 1, 5), ("body", 1, 7, 6), ("footer", 7, 8, 12))
OCR_LANGUAGE = "eng+hin"

CONVERT_WORKERS = 4
CONVERT_TIMEOUT = 180
CONVERT_RETRIES = 1
ERROR_TAIL = 300
CONVERTED_LANE = "pdf_from_doc"
