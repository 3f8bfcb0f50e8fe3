"""Declared schemas and the block vocabulary."""

from __future__ import annotations

#: Block types by class.
RUNNING = ("page_header", "page_footer", "page_number")
BODY = ("paragraph", "title", "list", "page_footnote", "page_aside_text")
TEXT = BODY + RUNNING
MODEL_MADE = ("table", "equation_interline", "chart")
FIGURES = ("image", "chart")
CAPTIONED = ("table", "chart", "image")
MASKED = ("table", "equation_interline", "chart", "image")
#: Names of block types in a report.
REPORT_TYPE = {"table": "table", "equation_interline": "formula", "chart": "chart", "image": "figure"}
TYPES = TEXT + MASKED

OUTLINE = "book string, idx int, level int, title string, page int"
CHANGES = "book string, seq int, level int, page int, old string, new string, note string"
WORDS = "book string, page_idx int, ord int, x0 double, y0 double, x1 double, y1 double, word string, block_no int, line_no int"
SPANS = "array<struct<type:string,content:string>>"
RAW_PAGES = "array<array<struct<type:string,bbox:array<double>,sub_type:string,content:string>>>"
HUNKS = "page int, anchor string, pdf_text string, md_text string"
