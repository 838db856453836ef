"""Text columns: stripping, HTML to plain text, previews, the extraction gate."""

from __future__ import annotations

from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as V


def py_strip(col: Column) -> Column:
    """Strip all Unicode white space; ``trim`` alone takes off spaces only."""
    return F.btrim(col, F.lit(V.WHITESPACE))


def is_blank(col: Column) -> Column:
    """NULL or the empty string. White space counts as content."""
    return F.coalesce(col == "", F.lit(True))


# --- HTML to text -----------------------------------------------------------------

_MARK, _LINE_MARK = "\x01", "\x02"
_BLOCK = "p|br|div|li|tr|h[1-6]"
_INLINE = "i|b|u|em|strong|code|pre|span|ul|ol|article|nav|section|small|sub|sup|blockquote"
_LINK = r'<a href="([^"<>\s]+)"(?: rel="nofollow")?>([^<]*)</a>'
_BLOCK_TAG = rf"<(?:(?:{_BLOCK})(?: ?/)?|/(?:{_BLOCK}))>"
_INLINE_TAG = rf"</?(?:{_INLINE})>"
# The ampersand comes last, so that nothing is decoded twice.
_ENTITIES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "'"), ("&#39;", "'"),
    ("&#x2F;", "/"), ("&nbsp;", "\xa0"), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&"),
)
_KNOWN_ENTITY = "|".join(e.strip("&;") for e, _ in _ENTITIES)
# An ampersand that may start some other entity, or could turn into one once a tag behind it
# is gone. Any other one, with neither a name nor a number behind it, stands for itself.
_HARD_AMPERSAND = rf"&(?!(?:{_KNOWN_ENTITY});|[^A-Za-z#<])"
# An ampersand that nothing closes up to the end of the post; it only counts near the end.
_OPEN_TAIL = r"&[^\s;<]*\z"
_TAIL_CHARS = 34


def _put(col: Column, old: str, new: str) -> Column:
    return F.replace(col, F.lit(old), F.lit(new))


def _with_plain_markup(df: DataFrame, html: str) -> DataFrame:
    """Add ``_plain``, whether the native form is exact for a post, and ``_native``, that form.

    It is exact for forum posts as a rule: block and inline tags without attributes,
    links with nothing but text inside, and well-known entities. A block tag becomes a
    mark, and marks become newlines where no newline is yet. Plain replacements do the
    usual tags, regular expressions only see posts that have something for them to do;
    every step is a column of its own and so evaluated once.
    """
    source, linked, marked, tagless = (F.col(c) for c in (html, "_linked", "_marked", "_tagless"))
    lines, text = F.col("_lines"), F.col("_text")

    linking = F.when(source.contains("</a>"), F.regexp_replace(source, _LINK, "$2 ($1)")).otherwise(source)
    marking = linked
    for tag, mark in (("<p>", _MARK), ("</p>", _MARK), ("<i>", ""), ("</i>", "")):
        marking = _put(marking, tag, mark)
    other_tags = F.regexp_replace(F.regexp_replace(marked, _BLOCK_TAG, _MARK), _INLINE_TAG, "")

    open_tail = F.right(source, F.lit(_TAIL_CHARS)).rlike(_OPEN_TAIL)
    hard = source.rlike(_HARD_AMPERSAND) | open_tail
    good_entities = F.when(source.contains("&"), ~hard).otherwise(True)
    no_marks = ~source.contains(_MARK) & ~source.contains(_LINE_MARK)

    # Marks at the start count for nothing, and one after a newline not either.
    lining = _put(_put(F.ltrim(tagless, F.lit(_MARK)), "\n" + _MARK, _LINE_MARK), 2 * _MARK, _MARK)
    runs = lines.contains(2 * _MARK) | lines.contains(_LINE_MARK + _MARK)
    breaking = F.when(
        runs, F.regexp_replace(lines, f"[{_MARK}{_LINE_MARK}]{_MARK}*", "\n")
    ).otherwise(_put(_put(lines, _MARK, "\n"), _LINE_MARK, "\n"))

    def decode(col: Column, numeric: bool) -> Column:
        for entity, char in _ENTITIES:
            if entity.startswith("&#") == numeric:
                col = _put(col, entity, char)
        return col

    numbers = F.when(text.contains("&#"), decode(text, numeric=True)).otherwise(text)
    names = F.col("_numbers")
    native = py_strip(F.when(names.contains("&"), decode(names, numeric=False)).otherwise(names))
    return (
        df.withColumn("_linked", linking)
        .withColumn("_marked", marking)
        .withColumn("_tagless", F.when(marked.contains("<"), other_tags).otherwise(marked))
        .withColumn("_plain", F.coalesce(no_marks & ~tagless.contains("<") & good_entities, F.lit(True)))
        .withColumn("_lines", lining)
        .withColumn("_text", breaking)
        .withColumn("_numbers", numbers)
        .withColumn("_native", F.coalesce(native, F.lit("")))
        .drop("_linked", "_marked", "_tagless", "_lines", "_text", "_numbers")
    )


class _PlainText(HTMLParser):
    """Collects the text of one post."""

    def __init__(self, clean: bool):
        super().__init__(convert_charrefs=True)
        self.clean = clean
        self.parts = []
        self.in_line = False  # something is written and its last character is no newline
        self.link = None
        self.hidden = False

    def write(self, text):
        if not self.hidden:
            self.parts.append(text)
            self.in_line = text[-1:] != "\n"

    def handle_data(self, data):
        self.write(data)

    def handle_starttag(self, tag, attrs):
        if tag in V.BLOCK_TAGS:
            self.break_line()
        elif tag == "a":
            self.link = dict(attrs).get("href")
        elif tag in ("script", "style"):
            self.hidden = self.clean

    def handle_endtag(self, tag):
        if tag in V.BLOCK_TAGS:
            self.break_line()
        elif tag in ("script", "style"):
            self.hidden = False
        elif tag == "a":
            if self.link:
                self.write(f" ({self.link})")
            self.link = None

    def break_line(self):
        if self.in_line:
            self.write("\n")


def parse_html(html: str | None, clean: bool = False) -> str:
    """Text of one post; ``clean`` drops scripts and styles and keeps an unfinished tail."""
    parser = _PlainText(clean)
    parser.feed(html or "")
    if clean:
        parser.close()
    return "".join(parser.parts).strip()


def _parser_udf(clean: bool):
    """The parser, row by row: a worker holds some hundred posts at a time, however many a task has."""

    @F.udf("string", useArrow=False)
    def html_text(html: str | None) -> str | None:
        return None if html is None else parse_html(html, clean)

    return html_text


def with_plain_text(df: DataFrame, html: str, out: str = "text", clean: bool = False) -> DataFrame:
    """Add ``out``, plain text with ``text (url)`` links; NULL and '' give ''.

    Plain markup stays in the JVM. The parser sees the other posts only: for plain ones
    it is handed NULL, so they cost no transfer.
    """
    for_parser = F.when(~F.col("_plain"), F.col(html))
    steps = _with_plain_markup(df, html).withColumn("_parsed", _parser_udf(clean)(for_parser))
    text = F.when(F.col("_plain"), F.col("_native")).otherwise(F.col("_parsed"))
    return steps.withColumn(out, text).drop("_plain", "_native", "_parsed")


# --- previews and the extraction gate ---------------------------------------------


def preview(html: Column) -> Column:
    """Readable beginning of a post: paragraphs as lines, tags removed, entities kept."""
    lines = F.replace(F.replace(html, F.lit("<p>"), F.lit("\n")), F.lit("</p>"), F.lit(""))
    text = py_strip(F.regexp_replace(lines, "<[^>]+>", ""))
    return F.when(
        F.length(text) > V.PREVIEW_CHARS,
        F.concat(F.substring(text, 1, V.PREVIEW_CHARS), F.lit("…")),
    ).otherwise(text)


def is_skipped(text: Column, is_deleted: Column, is_dead: Column) -> Column:
    """True for posts that are not worth a model call."""
    return (is_deleted != 0) | (is_dead != 0) | (F.length(py_strip(text)) < V.MIN_TEXT_CHARS)


def is_truncated(text: Column) -> Column:
    return F.length(text) > V.MAX_TEXT_CHARS


def truncate(text: Column) -> Column:
    return F.substring(text, 1, V.MAX_TEXT_CHARS)
