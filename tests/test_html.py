"""Pages as Markdown, against a plain recursive version, on made trees and on all pages."""

import random
import re
from html import escape, unescape
from itertools import groupby

from corpusloom.functions import html
from corpusloom.plans import catalogue

INLINE = {"b", "em", "del", "code", "a", "span", "br", "img", "script", "style", "head"}
MARKS = {"b": "**", "em": "*", "del": "~~", "code": "`"}
FOLDER = "/root/testdata/sf0.01"


def run(node, code=False):
    """A text or an inline element."""
    if isinstance(node, str):
        text = re.sub(r"\s+", " ", node)
        return text if code else re.sub(r"([*_])", r"\\\1", text)
    tag, have, kids = node
    if tag in ("script", "style", "head"):
        return ""
    if tag == "br":
        return "\n"
    if tag == "img":
        return f"![{have['alt']}]({have['src']})"
    text = "".join(run(k, code or tag == "code") for k in kids)
    if tag == "span" or not text.strip():
        return text
    left, right = (MARKS[tag], MARKS[tag]) if tag in MARKS else ("[", f"]({have['href']})")
    return re.sub(r"^(\s*)(.*?)(\s*)$", lambda m: m[1] + left + m[2] + right + m[3], text, flags=re.S)


def blocks(kids, depth=0):
    """Markdown of each block among some nodes."""
    for inline, group in groupby(kids, lambda k: isinstance(k, str) or k[0] in INLINE):
        if inline:
            text = re.sub(" *\n *", "  \n", re.sub(" +", " ", "".join(map(run, group)))).strip()
            if text:
                yield text
        else:
            for tag, have, inner in group:
                yield from block(tag, have, inner, depth)


def oneline(kids, depth):
    return " ".join(" ".join(blocks(kids, depth)).split())


def block(tag, have, kids, depth):
    if tag == "hr":
        yield "---"
    elif tag in ("h1", "h3"):
        if line := oneline(kids, depth):
            yield "#" * int(tag[1]) + " " + line
    elif tag == "blockquote":
        if text := "\n\n".join(blocks(kids, depth)):
            yield "\n".join(("> " + x).strip() if not x else "> " + x for x in text.split("\n"))
    elif tag == "pre":
        text = "".join(kids)
        fence = "`" * max(3, *(len(x) + 1 for x in re.findall("`*", text)))
        yield fence + "\n" + re.sub(r"^\n|\n+\Z", "", text) + "\n" + fence
    elif tag == "table":
        rows = [[oneline(c[2], depth).replace("|", "\\|") for c in r[2]] for r in kids if r[2]]
        if rows:
            rows = [r + [""] * (max(map(len, rows)) - len(r)) for r in rows]
            yield "\n".join("| " + " | ".join(r) + " |" for r in [rows[0], ["---" for _ in rows[0]]] + rows[1:])
    elif tag in ("ul", "ol"):
        done = []
        for _, _, inner in kids:
            text = ""
            for is_list, group in groupby(inner, lambda k: k[0] in ("ul", "ol") and not isinstance(k, str)):
                for part in blocks(list(group), depth + 1):
                    text += ("" if not text else "\n" if is_list else "\n\n") + part
            if text:
                marker = f"{int(have.get('start', 1)) + len(done)}. " if tag == "ol" else "*+-"[depth % 3] + " "
                done.append(marker + re.sub("\n(?=[^\n])", "\n" + " " * len(marker), text))
        if done:
            yield "\n".join(done)
    else:
        yield from blocks(kids, depth)


def plain(kids):
    return "\n\n".join(blocks(kids))


def made(rng, depth, inline=False):
    """Random nodes that stand where they may."""
    words = lambda: rng.choice(["a", "b_c ", " *d", "e & f", "  ", "\n", "<g>", "h|i", "ü`"])
    out = []
    for _ in range(rng.randrange(0, 4)):
        kind = rng.random()
        if depth == 0 or kind < 0.3:
            if not out or not isinstance(out[-1], str):
                out.append(words())
        elif inline or kind < 0.5:
            tag = rng.choice(sorted(INLINE - {"style", "head", "code"}))
            kids = [] if tag in ("br", "img") else ["var x;"] if tag == "script" else made(rng, depth - 1, True)
            out.append((tag, {"alt": "pic", "src": "/p"} if tag == "img" else {"href": "/u?a&b"} if tag == "a" else {}, kids))
        elif kind < 0.6:
            out.append(("code", {}, [rng.choice(["x_y", "*z*", " q "])]))
        elif kind < 0.7:
            tag = rng.choice(["ul", "ol"])
            out.append((tag, {"start": "7"} if tag == "ol" and rng.random() < 0.3 else {}, [("li", {}, made(rng, depth - 1)) for _ in range(rng.randrange(0, 4))]))
        elif kind < 0.76:
            out.append(("table", {}, [("tr", {}, [(rng.choice(["td", "th"]), {}, made(rng, depth - 1)) for _ in range(rng.randrange(0, 4))]) for _ in range(rng.randrange(0, 4))]))
        elif kind < 0.8:
            out.append(("pre", {}, [rng.choice(["k\n  l_m\n", "\n*n*", "o```p"])]))
        elif kind < 0.85:
            out.append(("hr", {}, []))
        elif kind < 0.92:
            out.append((rng.choice(["p", "h1", "h3"]), {}, made(rng, depth - 1, True)))
        else:
            out.append((rng.choice(["div", "section", "blockquote"]), {}, made(rng, depth - 1)))
    return out


def page_of(kids):
    out = ""
    for k in kids:
        if isinstance(k, str):
            out += escape(k)
        else:
            tag, have, inner = k
            out += f"<{tag}" + "".join(f' {a}="{escape(v)}"' for a, v in have.items()) + ">"
            out += "" if tag in ("br", "hr", "img") else ("".join(inner) if tag == "script" else page_of(inner)) + f"</{tag}>"
    return out


def test_made_trees_equal_the_plain_version():
    rng = random.Random(5)
    seen = set()
    for _ in range(4000):
        kids = made(rng, 5)
        page = page_of(kids)
        assert html.to_markdown(page) == plain(kids).strip(), page
        assert html.to_markdown(f"<p>n<div class='x content'>{page}</div>m", "content") == plain(kids).strip(), page
        seen.update(re.findall("<([a-z0-9]+)", page))
    assert {"ul", "ol", "table", "pre", "blockquote", "code", "a"} <= seen


def read(page):
    """Nodes of a page of the tables by patterns and recursion; a paragraph ends where the next block starts."""
    page = re.sub(r"<!--.*?-->|<!DOCTYPE[^>]*>", "", page, flags=re.S | re.I)
    tokens = re.findall(r"<(?:script|style)\b.*?</(?:script|style)>|</?[a-z][^>]*>|[^<]+|<", page, flags=re.S | re.I)
    at = 0

    def nodes(closers):
        nonlocal at
        out = []
        while at < len(tokens):
            t = tokens[at]
            m = re.match(r"<(/?)([a-z0-9]+)", t, flags=re.I)
            name = m and m[2].lower()
            if name and m[1]:
                if name in closers:
                    return out
                at += 1
            elif name in ("script", "style", "meta"):
                at += 1
                out += [("script", {}, [])] if name != "meta" else []
            elif name == "br":
                at += 1
                out.append(("br", {}, []))
            elif name:
                if "p" in closers and name not in INLINE and not set(closers[closers.index("p") + 1 :]) - INLINE:
                    return out
                at += 1
                inner = nodes([*closers, name])
                if at < len(tokens) and re.match(rf"</{name}\b", tokens[at], flags=re.I):
                    at += 1
                out.append((name, {k: unescape(v) for k, v in re.findall(r'([a-z]+)="([^"]*)"', t)}, inner))
            else:
                at += 1
                out.append(unescape(t))
        return out

    return nodes([])


def test_all_pages_equal_the_plain_version(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    got = {r["page_id"]: r["markdown"] for r in catalogue.QUERIES["html_markdown"](spark, FOLDER).collect()}
    assert got == {i: plain(read(p)).strip() if p else "" for i, p in pages.items()}
    assert sum(len(x) > 500 for x in got.values()) > 100


def test_what_pages_leave_out():
    md = html.to_markdown
    assert md("<ul><li>a<ul><li>b<p>c</p><ol start=9><li>d<li>e</ol></ul><li>f</ul>") == "* a\n  + b\n\n    c\n    9. d\n    10. e\n* f"
    assert md("<table><tr><th>h<th>i<tr><td>1|2<td><p>x<p>y</table>") == "| h | i |\n| --- | --- |\n| 1\\|2 | x y |"
    assert md("<table><caption>t</caption><thead><tr><td>a</tr><tbody><tr><td>b<td>c<table><tr><td>in</table></table>") == "t\n\n| a |  |\n| --- | --- |\n| b | c \\| in \\| \\| --- \\| |"
    assert md("a</b></div>b") == "ab" and md("<p>x<b>y") == "x**y**" and md("<li>x<li>y") == "* x\n\n* y"
    assert md("<ul>t<li>a</li>u<ul><li>v</ul></ul>") == "* t\n* a\n\n  u\n  + v"
    assert md("<a href=/x><div>p</div><div>q</div></a>") == "[p q](/x)" and md("<b> x </b>y<b></b>") == "**x** y"
    assert md("<div class=content>") == "" and md("") == "" and md(None, "content") == "" and md("<div>", "content") == ""
    assert md("<div>x" * 20000) == "\n\n".join(["x"] * 20000)
    assert md("<ul><li>" * 300 + "deep").endswith("deep") and md("<i>" * 20000 + "t") .count("t") == 1
