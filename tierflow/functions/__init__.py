"""Scalar functions as column expressions; none needs Python on the executors."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


#: What Python's ``strip`` takes off: the white space of Unicode and four separators. A fixed value.
BLANKS = r"[\s\x1c-\x1f\x85\p{Z}]"


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, f"^{BLANKS}+|{BLANKS}+$", "")


def safe_int(text: Column) -> Column:
    """An integer with thousands separators, else null; null too beyond 32 bits."""
    digits = F.replace(stripped(text), F.lit(","), F.lit(""))
    return F.when(digits.rlike(r"^[+-]?[0-9]+$"), digits.try_cast("int"))


def safe_float(text: Column) -> Column:
    """A number with thousands separators, else null."""
    digits = F.replace(stripped(text), F.lit(","), F.lit(""))
    return F.when(digits.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), digits.try_cast("double"))


POSTBACK = r"__doPostBack\('([^']*)','([^']*)'\)"  # a fixed pattern of the pages


def postback(href: Column, onclick: Column) -> Column:
    """(target, argument) of the first attribute that posts back; null if neither does."""
    hit = F.when(href.rlike(POSTBACK), href).when(onclick.rlike(POSTBACK), onclick)
    return F.when(hit.isNotNull(), F.struct(F.regexp_extract(hit, POSTBACK, 1).alias("target"), F.regexp_extract(hit, POSTBACK, 2).alias("argument")))


def is_totals_row(name: Column) -> Column:
    return name.rlike(r"^[0-9,\s]+$")


def next_page(current: Column, pages: Column, ellipsis: Column) -> Column:
    """The link to the next page, else the last ellipsis link, else null."""
    return F.when(current.isNotNull(), F.coalesce(F.try_element_at(pages, current + 1), F.try_element_at(ellipsis, F.lit(-1))))


FORBIDDEN = r'[<>:"/\\|?*]'  # fixed value: the signs that file names may not hold


def slugify(text: Column, most: int = 50) -> Column:
    """Blanks and forbidden signs become single underscores; at most ``most`` characters; never empty."""
    s = F.regexp_replace(F.replace(stripped(text), F.lit(" "), F.lit("_")), FORBIDDEN, "_")
    s = F.regexp_replace(F.regexp_replace(s, "_+", "_"), "^_+|_+$", "")
    s = F.regexp_replace(F.substring(s, 1, most), "_+$", "")
    return F.coalesce(F.nullif(s, F.lit("")), F.lit("unnamed"))


def storage_path(year: Column, kind: Column, district: Column, body: Column, number: Column) -> Column:
    parts = [slugify(c, n) for c, n in ((year, 20), (kind, 30), (district, 40), (body, 60), (number, 30))]
    return F.concat(F.lit("pdfs/"), F.concat_ws("/", *parts), F.lit(".pdf"))


def content_hash(data: Column) -> Column:
    return F.sha2(data, 256)


# Fixed value: where the portal's headers name a file: an optional asterisk, an optional quote, then all up to a quote, a
# semicolon or the line's end.
DISPOSITION = r"""filename[*]?=["']?([^"';\n]+)"""


def disposition_filename(header: Column, lower: bool = True) -> Column:
    """The file name of a Content-Disposition header; null without one."""
    header = F.lower(header) if lower else header
    return F.nullif(F.regexp_extract(header, DISPOSITION, 1), F.lit(""))


def is_pdf_response(content_type: Column, disposition: Column) -> Column:
    kind, shown = F.lower(F.coalesce(content_type, F.lit(""))), F.lower(F.coalesce(disposition, F.lit("")))
    return kind.contains("application/pdf") | kind.contains("octet-stream") | shown.contains(".pdf")


def file_year(label: Column) -> Column:
    return F.translate(label, "/\\ ", "--_")


def format_bytes(n: Column) -> Column:
    """Bytes below 1024 as they are, then KB, MB and GB with one decimal; exact halves go to the even digit."""
    shown = lambda power, unit: F.format_string(f"%.1f {unit}", F.bround(n / 1024.0**power, 1))
    return F.when(n >= 1024**3, shown(3, "GB")).when(n >= 1024**2, shown(2, "MB")).when(n >= 1024, shown(1, "KB")).otherwise(F.concat(F.coalesce(n, F.lit(0)).cast("string"), F.lit(" B")))


def format_number(n: Column) -> Column:
    return F.format_number(F.coalesce(n, F.lit(0)), 0)


def format_pct(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, "0%").otherwise(F.format_string("%.1f%%", F.round(part / F.nullif(whole, F.lit(0)) * 100, 1)))


def format_currency(value: Column) -> Column:
    return F.concat(F.lit("₹"), F.format_number(F.coalesce(value.try_cast("bigint"), F.lit(0)), 0))


def truncate(text: Column, most: int = 50) -> Column:
    text = F.coalesce(text, F.lit(""))
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most - 3), F.lit("..."))).otherwise(text)


def progress_text(done: Column, total: Column) -> Column:
    return F.concat(done.cast("string"), F.lit("/"), F.when(F.coalesce(total, F.lit(0)) == 0, "?").otherwise(total.cast("string")))


# The icons of statuses in the reports, by kind of row. Any other status has the icon of ``UNKNOWN``.
ICONS = {
    "run": {"PENDING": "⏳", "RUNNING": "🔄", "COMPLETED": "✅", "FAILED": "❌"},
    "district": {"PENDING": "⏳", "IN_PROGRESS": "🔄", "DONE": "✅", "ERROR": "❌"},
    "body": {"PENDING": "⏳", "IN_PROGRESS": "🔄", "PARTIAL": "📊", "DONE": "✅", "ERROR": "❌"},
    "project": {"PENDING": "⏳", "DOWNLOADING": "🔄", "DOWNLOADED": "✅", "MISSING": "⚠️", "ERROR": "❌"},
    "pdf": {"PENDING": "⏳", "UPLOADED": "✅", "FAILED": "❌"},
}
UNKNOWN = "❓"


def status_icon(status: Column, kind: str = "project") -> Column:
    return F.coalesce(F.create_map(*(F.lit(x) for kv in ICONS[kind].items() for x in kv))[status], F.lit(UNKNOWN))


def district_icon(done: Column, pending: Column, total: Column) -> Column:
    return F.when(done == total, "✅").when(pending > 0, "🔄").otherwise("❌")


def hours_remaining(remaining: Column, uploads_30_min: Column) -> Column:
    """Hours at the present rate; null stands for no end in sight."""
    return F.when(uploads_30_min > 0, F.round(remaining / (uploads_30_min / 30.0 * 60), 2))


def tiles(pages: Column, per: int = 4) -> Column:
    return F.ceil(pages / per).cast("int")


def cost(tokens_in: Column, tokens_out: Column, price_in: float, price_out: float) -> Column:
    """Prices are per million tokens."""
    return tokens_in / 1e6 * price_in + tokens_out / 1e6 * price_out


def era(year: Column) -> Column:
    return F.when(year.between(2012, 2016), "2012-2016").when(year.between(2017, 2020), "2017-2020").when(year.between(2021, 2026), "2021-2026")


def elapsed_ms(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MILLISECOND", start, end)


def natural_id(*key: Column) -> Column:
    """An id that repeats for equal keys, in place of a random one."""
    return F.sha2(F.concat_ws("\x1f", *(F.coalesce(k.cast("string"), F.lit("")) for k in key)), 256)


def prefix(text: Column, n: int, dots: bool = False) -> Column:
    cut = F.substring(text, 1, n)
    return F.concat(cut, F.lit("...")) if dots else cut
