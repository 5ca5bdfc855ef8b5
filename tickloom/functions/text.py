"""Markdown, prompt and JSON text expressions; every one is a plain column plan."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.schemas import MIN_BULLETS_TO_SPLIT, MIN_CHUNK_CHARS, TICK_EVENT

# The characters that count as blank, the line ends, and the
# markdown patterns. (?d) makes a newline the only line end for ^, $ and the dot.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
LINE_END = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
FRONT_OPEN = "---\n"
FRONT_CLOSE = "\n---\n"
HEADING = f"(?md)^##+[{BLANKS}]+(.*)$"
BULLET = r"(?md)^- "
WORD = "[a-z0-9]+"
NO_SOURCES = "none"
UNKNOWN_PUBLISHER = "Unknown source"
NO_TITLE = "No title"
NO_LINK = "#"


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once.

    A lambda recomputes every outer expression it mentions for each element;
    bound as a one-element array it is a variable instead.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def plain_newlines(text: Column) -> Column:
    return F.regexp_replace(text, "\r\n?", "\n")


def _front_end(raw: Column) -> Column:
    """Where the block that closes a leading ``---`` line starts, 0 when there is none."""
    close = F.locate(FRONT_CLOSE, raw, len(FRONT_OPEN) + 1)
    return F.when(F.startswith(raw, F.lit(FRONT_OPEN)), close).otherwise(F.lit(0))


def front_matter(raw: Column) -> Column:
    """``key: value`` lines of a leading ``---`` block as a map; a repeated key keeps its last value."""
    skip = len(FRONT_OPEN) + 1
    block = let(
        _front_end(raw),
        lambda end: F.when(end > 0, F.substr(raw, F.lit(skip), end - F.lit(skip))).otherwise(F.lit("")),
    )
    lines = F.split(block, LINE_END)
    pairs = F.transform(
        F.filter(lines, lambda line: F.contains(line, F.lit(":"))),
        lambda line: F.struct(
            strip(F.substring_index(line, ":", 1)).alias("key"),
            strip(F.substr(line, F.instr(line, ":") + 1)).alias("value"),
        ),
    )

    def last_of_each(all_pairs: Column) -> Column:
        return F.filter(
            all_pairs,
            lambda p, i: ~F.exists(
                F.slice(all_pairs, i + 2, F.size(all_pairs)), lambda q: q["key"] == p["key"]
            ),
        )

    return F.map_from_entries(let(pairs, last_of_each))


def body_text(raw: Column) -> Column:
    """The text after the front matter, or all of it when there is none."""
    return strip(
        let(
            _front_end(raw),
            lambda end: F.when(end > 0, F.substr(raw, end + len(FRONT_CLOSE))).otherwise(raw),
        )
    )


def with_entry(entries: Column, key: str, value: Column) -> Column:
    """The map with ``key`` set to ``value``."""
    return F.map_concat(F.map_filter(entries, lambda k, _: k != F.lit(key)), F.create_map(F.lit(key), value))


def sections(body: Column) -> Column:
    """Array of (heading, text) at ``##`` headings; text before the first has an empty heading."""
    headings = F.concat(F.array(F.lit("")), F.regexp_extract_all(body, F.lit(HEADING), F.lit(1)))
    texts = F.split(body, HEADING)
    rows = F.zip_with(
        headings, texts, lambda h, t: F.struct(strip(h).alias("heading"), strip(t).alias("text"))
    )
    return F.filter(rows, lambda s: s["text"] != F.lit(""))


def _pieces(heading: Column, text: Column) -> Column:
    """One piece per bullet for a list-shaped section, else the section itself."""
    lead = F.when(heading != F.lit(""), F.concat(heading, F.lit("\n\n"))).otherwise(F.lit(""))

    def items(parts: Column) -> Column:
        stripped = F.transform(F.slice(parts, 2, F.size(parts)), strip)
        kept = F.filter(stripped, lambda item: item != F.lit(""))
        is_list = F.size(parts) > F.lit(MIN_BULLETS_TO_SPLIT)
        return F.when(is_list, F.transform(kept, lambda item: F.concat(lead, F.lit("- "), item)))

    bullets = let(F.split(text, BULLET), items)
    return let(bullets, lambda found: F.when(F.size(found) > F.lit(0), found).otherwise(F.array(text)))


def _header(title: Column, heading: Column) -> Column:
    return F.concat_ws(" - ", F.nullif(title, F.lit("")), F.nullif(heading, F.lit("")))


def _titled(header: Column, piece: Column) -> Column:
    missing = (header != F.lit("")) & ~F.contains(piece, header)
    return strip(F.when(missing, F.concat(header, F.lit("\n\n"), piece)).otherwise(piece))


def section_pieces(body: Column) -> Column:
    """Array of (heading, pieces) per section, list sections split by bullet."""
    return F.transform(
        sections(body),
        lambda s: F.struct(
            s["heading"].alias("heading"), _pieces(s["heading"], s["text"]).alias("pieces")
        ),
    )


def chunk_texts(title: Column, body: Column) -> Column:
    """The chunk texts of one document in order, short ones dropped."""
    titled = F.transform(
        section_pieces(body),
        lambda s: let(
            _header(title, s["heading"]),
            lambda header: F.transform(s["pieces"], lambda piece: _titled(header, piece)),
        ),
    )
    return F.filter(F.flatten(titled), long_enough)


def long_enough(chunk: Column) -> Column:
    return F.length(chunk) >= F.lit(MIN_CHUNK_CHARS)


def n_grams(text: Column, n: int = 5) -> Column:
    """Runs of ``n`` lower-case words joined by blanks."""

    def runs(words: Column) -> Column:
        starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - F.lit(n - 1)))
        return F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))

    words = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    return F.coalesce(let(words, runs), F.array().cast("array<string>"))


def retrieval_query(ticker: Column) -> Column:
    return F.concat(ticker, F.lit(" market context technical analysis"))


def passage_source(metadata: Column, passage_id: Column) -> Column:
    return F.coalesce(F.try_element_at(metadata, F.lit("source")), passage_id)


def sources_line(sources: Column) -> Column:
    return F.coalesce(F.nullif(F.array_join(sources, ", "), F.lit("")), F.lit(NO_SOURCES))


def escape_dollar(text: Column) -> Column:
    return F.replace(text, F.lit("$"), F.lit("\\$"))


def parse_tick(value: Column) -> Column:
    """JSON text to the tick struct; text that is not JSON gives a struct of nulls."""
    return F.from_json(value, TICK_EVENT)


def render_tick(ticker: Column, price: Column, size: Column, event_time: Column) -> Column:
    return F.to_json(
        F.struct(
            ticker.alias("ticker"), price.alias("price"), size.alias("size"), event_time.alias("event_time")
        )
    )


def _is_object(part: Column) -> Column:
    return F.startswith(part, F.lit("{"))


def news_item(item: Column) -> Column:
    """Title, publisher and link of one news entry, which may nest under ``content``."""
    nested = F.get_json_object(item, "$.content")
    content = F.coalesce(nested, item)

    def part(path: str) -> Column:
        return F.get_json_object(content, path)

    has_click = F.coalesce(
        F.array_contains(F.json_object_keys(content), "clickThroughUrl"), F.lit(False)
    )
    publisher = F.when(_is_object(part("$.provider")), part("$.provider.displayName"))
    own_link = F.coalesce(part("$.canonicalUrl"), F.lit(NO_LINK))
    link = F.when(~has_click, own_link).when(
        _is_object(part("$.clickThroughUrl")), F.coalesce(part("$.clickThroughUrl.url"), own_link)
    )
    return F.struct(
        F.coalesce(part("$.title"), F.lit(NO_TITLE)).alias("title"),
        F.coalesce(publisher, F.lit(UNKNOWN_PUBLISHER)).alias("publisher"),
        F.coalesce(link, F.lit(NO_LINK)).alias("link"),
    )
