"""Scalar text functions as Spark columns; white space is Unicode's ((?U) in Java's patterns)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that file names and links may not hold.
ILLEGAL = r'[\\/:*?"<>|#^\[\]]'
ILLEGAL_TITLE = r'[\\/:*?"<>|]'

#: Limits of names, titles, prompts and summaries; the mark of a cut prompt; marks of generated blocks.
NAME_LIMIT, TITLE_LIMIT, PROMPT_LIMIT, SUMMARY_LIMIT = 180, 200, 16_000, 200
TRUNCATED = "\n\n[...truncated...]"
NAV_START, NAV_END = "<!-- vault:nav-start -->", "<!-- vault:nav-end -->"
RELATED_START, RELATED_END = "<!-- vault:related-start -->", "<!-- vault:related-end -->"

#: White space at the ends of a text, as Unicode and the file formats have it.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def collapse(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+", " ")


def or_else(c: Column, default: str) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


def safe_filename(c: Column) -> Column:
    """Without illegal characters, outer white space and trailing dots; at most 180 code points; "Untitled" if nothing is left."""
    bare = F.regexp_replace(strip(F.regexp_replace(c, ILLEGAL, "")), r"\.+$", "")
    return or_else(F.left(collapse(bare), F.lit(NAME_LIMIT)), "Untitled")


def sanitize_title(c: Column) -> Column:
    """Illegal characters become dashes; outer blanks and dots go; at most 200 code points; "untitled" if nothing is left."""
    dashed = collapse(F.regexp_replace(c, ILLEGAL_TITLE, "-"))
    bare = F.btrim(dashed, F.lit(" .\t\n\r"))
    return or_else(F.when(F.length(bare) > TITLE_LIMIT, F.rtrim(F.left(bare, F.lit(TITLE_LIMIT)), F.lit(" ."))).otherwise(bare), "untitled")


def clean_title(c: Column) -> Column:
    """Without a leading "12. "."""
    return strip(F.regexp_replace(c, r"(?U)^\s*\d+\.\s*", ""))


def strip_index(c: Column) -> Column:
    """Without a leading "12-"."""
    return F.regexp_replace(c, r"^\d+-", "")


def strip_heading(c: Column) -> Column:
    """Without a leading level-one heading and the blank lines after it."""
    return F.regexp_replace(c, r"\A\s*# [^\n]*(?:\n[^\S\n]*(?=\n|\z))*\n?", "")


def strip_quote(c: Column) -> Column:
    """Without one leading quoted line."""
    return F.regexp_replace(c, r"\A\s*>\s.*\n+", "")


def strip_frontmatter(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\A---\n.*?\n---\n", "")


def strip_blocks(c: Column) -> Column:
    """Without the generated blocks of navigation and related concepts; ends in one newline."""
    for start, end in ((NAV_START, NAV_END), (RELATED_START, RELATED_END)):
        c = F.regexp_replace(c, rf"(?s){start}.*?{end}\n*", "")
    return F.concat(F.rtrim(c, F.lit(SPACES)), F.lit("\n"))


def transcript_section(c: Column, whole_if_missing: bool = False) -> Column:
    """What stands under "## Transcript", up to the next heading of that level or generated block; else nothing, or the whole text."""
    heading = r"(?ms)^##\s+Transcript\s*\n+"
    got = F.regexp_extract(c, heading + r"(.*?)(?=\n##\s|\n<!--\s*vault:|\z)", 1)
    return F.when(c.rlike(heading), strip(got)).otherwise(strip(c) if whole_if_missing else F.lit(""))


def transcript_body(c: Column, rendered: Column) -> Column:
    """The transcript in a note's body: a rendered note's own section, or a raw one without its heading and leading quoted line."""
    bare = F.array(strip(strip_heading(strip_blocks(c))))  # made once
    return F.transform(bare, lambda b: F.when(rendered, transcript_section(b)).otherwise(strip(strip_quote(b))))[0]


def path_hint(course: Column, sub_course: Column, module: Column) -> Column:
    return F.concat(course, F.lit("/"), F.coalesce(F.nullif(sub_course, F.lit("")), module))


def model_input(notes: Column, transcript: Column) -> Column:
    """Both sources under their headings, those that are not empty."""
    part = lambda title, c, end: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"{title}:\n"), c, F.lit(end))).otherwise(F.lit(""))
    return F.concat(part("LESSON NOTES", notes, "\n\n"), part("TRANSCRIPT", transcript, ""))


def user_message(title: Column, hint: Column, body: Column) -> Column:
    return F.concat(F.lit("LESSON PATH: "), hint, F.lit("\nTITLE: "), title, F.lit("\n\nTRANSCRIPT:\n"), prompt_body(body))


def frontmatter_value(c: Column, key: str) -> Column:
    """One scalar of the frontmatter by its key, without quotes; null if absent or empty."""
    head = F.regexp_extract(c, r"(?s)\A---\n(.*?)\n---\n", 1)
    return F.nullif(F.regexp_extract(head, rf"""(?m)^{key}:\s*['"]?([^'"\n]+?)['"]?\s*$""", 1), F.lit(""))


def normalize_concept(c: Column) -> Column:
    return F.lower(strip(F.regexp_replace(c, r'[\\/:*?"<>|]', "")))


def wikilinks(c: Column) -> Column:
    """Targets of [[target]] and [[target|shown]]; a target with # is no match."""
    return F.regexp_extract_all(c, F.lit(r"\[\[([^\]|#]+)(?:\|[^\]]+)?\]\]"), F.lit(1))


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def parent(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def wikilink(path: Column, shown: Column) -> Column:
    """[[path|shown]], or [[path]] where shown is the file's own name; without .md."""
    bare = F.regexp_replace(path, r"\.md$", "")
    return F.when(shown == basename(bare), F.concat(F.lit("[["), bare, F.lit("]]"))).otherwise(F.concat(F.lit("[["), bare, F.lit("|"), shown, F.lit("]]")))


def numbered_name(index: Column, title: Column) -> Column:
    """"07. Title.md"; indexes over 99 keep their digits."""
    return F.concat(F.format_string("%02d", index.cast("int")), F.lit(". "), safe_filename(clean_title(title)), F.lit(".md"))


def yaml_quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))


def body_hash(page: Column, transcript: Column) -> Column:
    """First 16 hex digits of the digest of both sources."""
    both = F.concat(F.lit("HTML::"), F.coalesce(page, F.lit("")), F.lit("\nTRANSCRIPT::"), F.coalesce(transcript, F.lit("")))
    return F.substring(F.sha2(both, 256), 1, 16)


def prompt_body(c: Column, limit: int = PROMPT_LIMIT) -> Column:
    return F.when(F.length(c) > limit, F.concat(F.left(c, F.lit(limit)), F.lit(TRUNCATED))).otherwise(c)


def tokens_estimate(chars: Column) -> Column:
    return F.floor(chars * 0.25).cast("long")


def words(c: Column) -> Column:
    """Runs without white space."""
    return F.array_remove(F.split(strip(c), r"(?U)\s+"), "")


def sentences(c: Column) -> Column:
    return F.split(c, r"(?U)(?<=[.!?])\s+", -1)


def sentence_ends(c: Column) -> Column:
    return F.size(F.regexp_extract_all(c, F.lit(r"(?U)[.!?]\s"), F.lit(0))) + 1


def kebab(c: Column) -> Column:
    return F.replace(F.lower(strip(c)), F.lit(" "), F.lit("-"))


def json_object(c: Column) -> Column:
    """The outermost {...} of a model's answer, fences and prose around it left out."""
    bare = F.regexp_replace(F.regexp_replace(strip(c), r"\A```(?:json)?\s*", ""), r"\s*```\s*\z", "")
    return F.coalesce(F.nullif(F.regexp_extract(bare, r"(?s)(\{.*\})", 1), F.lit("")), bare)


def _server(url: Column) -> Column:
    return F.element_at(F.split(F.regexp_replace(F.replace(F.replace(url, F.lit("http://"), F.lit("")), F.lit("https://"), F.lit("")), "/+$", ""), "/"), 1)


def server_host(url: Column) -> Column:
    return F.regexp_replace(_server(url), ":[^:]*$", "")


def server_port(url: Column) -> Column:
    """The named port, 80 where it is no number; else that of the scheme."""
    own = _server(url)
    named = F.coalesce(F.regexp_extract(own, ":([^:]*)$", 1).try_cast("int"), F.lit(80))
    return F.when(own.contains(":"), named).when(url.startswith("https"), F.lit(443)).otherwise(F.lit(80))


def normalized_servers(urls: Column) -> Column:
    """Without blanks, empty ones and trailing slashes, each once, order kept."""
    full = F.filter(F.transform(urls, strip), lambda u: u != "")
    return F.array_distinct(F.transform(full, lambda u: F.regexp_replace(u, "/+$", "")))


def http_failure(status: Column) -> Column:
    return F.when(status.between(400, 499), F.lit("permanent")).otherwise(F.lit("transient"))


def community_slug(url: Column, host: str) -> Column:
    """First path part of a URL of that host."""
    return F.nullif(F.regexp_extract(url, host.replace(".", r"\.") + r"/([^/]+)(/|$)", 1), F.lit(""))


def html_content(page: Column, tag: str = "div", attribute: str = ' class="content"') -> Column:
    """What stands in the first such element, up to the first end tag."""
    return F.regexp_extract(page, rf"(?s)<{tag}{attribute}>(.*?)</{tag}>", 1)


def html_text_length(page: Column, tag: str = "div", attribute: str = ' class="content"') -> Column:
    return F.length(strip(collapse(F.regexp_replace(html_content(page, tag, attribute), "<[^>]+>", " "))))


def html_container(page: Column, name: str) -> Column:
    """From the first div with that class, whatever its quotes and other attributes, up to its own end tag.

    End tags are counted: of the pieces that begin at the div's tags the first after
    which as many divs are closed as were opened ends it.
    """
    start = F.regexp_extract(page, rf"""(?is)(<div\b[^>]*\bclass\s*=\s*(?:"[^"]*(?<![\w-]){name}(?![\w-])[^"]*"|'[^']*(?<![\w-]){name}(?![\w-])[^']*'|{name}(?=[\s>])).*)""", 1)
    parts = F.split(start, r"(?i)(?=<div\b)|(?<=</div>)")
    none = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("held"), F.lit(False).alias("done"))

    def step(acc: Column, part: Column) -> Column:
        depth = acc["depth"] + F.when(part.rlike(r"(?i)^<div\b"), 1).otherwise(0) - F.when(part.rlike(r"(?i)</div>$"), 1).otherwise(0)
        return F.when(acc["done"] | (part == ""), acc).otherwise(F.struct(depth.alias("depth"), F.array_append(acc["held"], part).alias("held"), (depth <= 0).alias("done")))

    return F.array_join(F.aggregate(parts, none, step)["held"], "")


def html_links(page: Column) -> Column:
    """(label, href) of links that have both; quotes of either kind or none; labels without tags and in single blanks."""
    link = F.lit(r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))[^>]*>(.*?)</a>""")
    group = lambda i: F.regexp_extract_all(page, link, F.lit(i))
    hrefs = F.transform(F.arrays_zip(group(1).alias("a"), group(2).alias("b"), group(3).alias("c")), lambda h: strip(F.concat(h["a"], h["b"], h["c"])))
    pairs = F.zip_with(group(4), hrefs, lambda t, h: F.struct(strip(collapse(F.regexp_replace(t, "<[^>]+>", " "))).alias("label"), h.alias("href")))
    return F.filter(pairs, lambda p: (p["label"] != "") & (p["href"] != ""))


def decoded(content: Column) -> Column:
    """Bytes as text; what is no UTF-8 becomes the replacement sign."""
    return F.make_valid_utf8(content.cast("string"))


def retry_waits(kind: str, attempts: int) -> list[float]:
    """Seconds before each further attempt (fixed values): posts 2, 8 and 32; model calls 2^k + 0.3 k."""
    return [float(x) for x in (2, 8, 32)][: max(0, attempts - 1)] if kind == "post" else [round(2**k + 0.3 * k, 1) for k in range(max(0, attempts - 1))]


def timestamp_seconds(t: Column) -> Column:
    return F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def timestamp_micros(t: Column) -> Column:
    """As ISO text with an offset; microseconds only where there are any."""
    return F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.date_format(t, "SSSSSS") != "000000", F.concat(F.lit("."), F.date_format(t, "SSSSSS"))).otherwise(F.lit("")), F.lit("+00:00"))
