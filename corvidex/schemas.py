"""Schemas of the tables that operators exchange. An absent key of a manifest entry is a null column."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, IntegerType, LongType, MapType, StringType, StructField, StructType, TimestampNTZType

FILES = "path string, name string, length long, header binary, sample binary, file_hash string, error string, extension string, modified timestamp"

FILE_INFO = "path string, name string, extension string, size_mb double, is_encrypted boolean, encoding string, page_count int, error string"

_TYPES = {"string": StringType(), "long": LongType(), "double": DoubleType(), "int": IntegerType(), "timestamp_ntz": TimestampNTZType(), "profile": MapType(StringType(), IntegerType())}

#: Built without a session, so that modules can be imported before there is one.
MANIFEST = StructType(
    [
        StructField(name, _TYPES[kind])
        for name, kind in (
            ("file_hash", "string"), ("path", "string"), ("lane", "string"), ("size_mb", "double"), ("n_bytes", "long"), ("status", "string"), ("triaged_at", "timestamp_ntz"),
            ("convert_status", "string"), ("converted_pdf", "string"), ("page_profile", "profile"), ("page_count", "int"), ("ocr_status", "string"), ("ocr_output", "string"),
        )
    ]
)

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"
PAGE_FACTS = f"file_hash string, path string, origin string, page_num int, text string, width double, height double, images array<{BOX}>, tables array<{BOX}>, spans array<struct<size:double,text:string>>, error string"

#: One attempt to convert a file; ``slot`` is the task that made it.
ATTEMPTS = "file_hash string, path string, output string, attempt int, slot int, success boolean, seconds double, error string"
CONVERSIONS = "file_hash string, path string, success boolean, seconds double, output string, error string, attempts int, history array<struct<attempt:int,slot:int,success:boolean,seconds:double,error:string>>"

OCR_WORDS = "file_hash string, page_num int, text array<string>, conf array<string>"
OCR_DOCUMENT = "file_hash string, source_pdf string, ocr_results array<struct<text:string,confidence:double,language:string,page_num:long,word_count:long>>, total_pages long"
