"""Main text of web pages, with templates deduced from the pages of a host.

A page is a sequence of tokens: the paths of its elements, and its text blocks with their path. Over the pages of a host each token has
an occurrence vector (the page bodies it occurs on). Tokens that share a vector form an equivalence class; vectors are compared by
a sum of hashes over bodies, so a class is found by two aggregates and a hot host is combined before the shuffle. A class is valid
when it occurs on enough bodies; classes nest as their paths do, from the class of the tokens on every page down. A text block in the class of its own path says the same wherever that path occurs: it belongs to the template.
The other blocks are the slots. What is extracted are the slots of the article, without the parts that are not main text by their element or name.
A body is what a page says after those parts are left out, so copies of a page, with whatever adverts around, have one vote. Where pages share more than
they differ in, they are edited copies, and what they share is no template.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_bitmap, key_bitmap, mapped, written

#: Different bodies that must share a class before it counts as a template.
LEAST_PAGES = 5
#: The same outside articles, where few pages count as far as they are no edited copies.
LEAST_BODIES = 2
ENOUGH = f"not main or bodies >= {LEAST_PAGES}"
WEAK = f"main or bodies < {LEAST_PAGES}"

# Elements by their role.
RAW = {"script", "style", "title", "textarea", "noscript", "template", "iframe", "xmp", "noembed"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
ASIDE = {"nav", "header", "footer", "aside", "form", "script", "style", "noscript", "template", "iframe", "svg", "button", "select", "textarea",
         "menu", "dialog", "head", "title", "object", "canvas", "video", "audio"}
BLOCKS = {"address", "article", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure",
          "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main", "nav", "ol", "p", "pre", "section", "summary",
          "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
#: Opening one of these closes an open element of the second set, up to the nearest element of the third.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
NAMES = (r"ads?|adverts?|advertisement|advertising|banner|breadcrumbs?|byline|comments?|commentlist|cookies?|consent|disclaimer|footer|header|masthead|menu|"
         r"modal|nav|navbar|navigation|newsletter|notice|notification|pagination|popup|promo|promoted|promotion|related|reply|replies|respond|share|"
         r"sharing|sidebar|social|sponsor|sponsored|subscribe|subscription|toolbar|widget|alert|aside|recommended|signup")
_NAMED = re.compile(rf"(?:^|[\s_-])(?:{NAMES})(?:$|[\s_-])", re.I)
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar"}
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_SPACE = re.compile(r"\s+")


def _left_out(tag: str, attributes: str) -> bool:
    if tag in ASIDE:
        return True
    if attributes and tag not in ("html", "body", "article", "main"):
        for m in _ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), (m[2] or "").strip("\"'")
            if name in ("class", "id") and _NAMED.search(value) or name == "role" and value.lower() in _ROLES:
                return True
            if name == "hidden" and m.start() and attributes[m.start() - 1].isspace() or name == "aria-hidden" and value.lower() == "true":
                return True
    return False


def blocks(page: str):
    """[(path, left out, in an article or main element, text)] of a page, in order. White space inside a block is one space; empty blocks are left out."""
    out, open_, text = [], [], []  # open_: (tag, left out, in article)
    at = 0

    def state():
        return open_[-1][1:] if open_ else (False, False)

    def flush():
        if text:
            line = _SPACE.sub(" ", html.unescape("".join(text))).strip()
            text.clear()
            if line:
                out.append(("/".join(x[0] for x in open_ if x[0] in BLOCKS or x[1]), *state(), line))

    def close(i):
        if any(x[0] in BLOCKS or x[1] for x in open_[i:]):
            flush()
        del open_[i:]

    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            text.append(page[at:])
            break
        text.append(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag, ending = m[2].lower(), m[1] == "/"
        if ending:
            i = next((i for i in range(len(open_) - 1, -1, -1) if open_[i][0] == tag), None)
            if tag in BLOCKS:
                flush()
            if i is not None:
                close(i)
            continue
        if tag in BLOCKS:
            flush()
            i = next((i for i in range(len(open_) - 1, -1, -1) if open_[i][0] == "p"), None)
            if i is not None and not any(x[0] in ("td", "th", "button", "object") for x in open_[i:]):
                close(i)
        if tag in CLOSES:
            shut, until = CLOSES[tag]
            for i in range(len(open_) - 1, -1, -1):
                if open_[i][0] in until:
                    break
                if open_[i][0] in shut:
                    close(i)
                    break
        if tag == "br":
            text.append(" ")
        if tag in VOID or m[3].endswith("/") and tag not in BLOCKS:
            continue
        gone, inside = state()
        leaves = gone or _left_out(tag, m[3])
        if leaves != gone:
            flush()
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        open_.append((tag, leaves, inside or tag in ("article", "main")))
    flush()
    return out


def _hash(host: str, kind: str, value: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(f"{host}\x00{kind}\x00{value}") - (1 << 63)


def _host(url):
    found = re.search(r"://([^/?#]*)", url or "")
    return found[1].lower() if found else ""


def parsed(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(row, i, u, main, body, path, token, chars, text): the blocks of every page that are not left out, of its articles if it has one. ``body`` is the
    hash of all of them."""

    def run(batch):
        rows = {"i": [], "u": [], "main": [], "body": [], "path": [], "token": [], "chars": [], "text": []}
        for i, url, page in zip(*(batch.column(c).to_pylist() for c in range(3))):
            host, found = _host(url), blocks(page or "")
            main = any(inside and not gone for _, gone, inside, _ in found)
            kept = [(path, text) for path, gone, inside, text in found if not gone and (inside or not main)]
            rows["i"].append(i), rows["u"].append(url), rows["main"].append(main)
            rows["body"].append(_hash(host, "body", "\x00".join(x for b in kept for x in b)))
            rows["path"].append([_hash(host, "path", path) for path, _ in kept])
            rows["token"].append([_hash(host, "text", f"{path}\x00{text}") for path, text in kept])
            rows["chars"].append([len(text) for _, text in kept]), rows["text"].append([text for _, text in kept])
        types = [pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.string())]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), types)], list(rows))

    out = mapped(pages.select(F.col(id_col).cast("long").alias("i"), F.col(url_col).cast("string").alias("u"), F.col(html_col).cast("string").alias("h")),
                 run, "i long, u string, main boolean, body long, path array<long>, token array<long>, chars array<int>, text array<string>")
    return written(out.withColumn("row", F.monotonically_increasing_id()), "slots")


def template_texts(slots: DataFrame) -> DataFrame:
    """(token, main, bodies): text tokens that are in the equivalence class of their path, on enough different bodies of their host."""
    texts = slots.select("main", "body", F.explode(F.arrays_zip("path", "token")).alias("b")).select("b.token", "b.path", "main", "body")
    paths = texts.select(F.col("path").alias("token"), F.lit(None).cast("long").alias("path"), "main", "body")
    votes = texts.union(paths).distinct().groupBy("token", "path", "main")
    vectors = written(votes.agg(F.count("*").alias("bodies"), F.sum(F.shiftright("body", 16).cast("decimal(38,0)")).alias("vector"))
                      .filter(F.col("bodies") >= LEAST_BODIES), "vectors")
    path = vectors.filter("path is null").select(F.col("token").alias("path"), "bodies", "vector")
    return written(vectors.filter("path is not null").join(path, ["path", "bodies", "vector"], "left_semi").filter(ENOUGH)
                   .select("token", "main", "bodies"), "shared")


def template_blocks(slots: DataFrame) -> DataFrame:
    """(row, drop): the places of the template texts of each page that has any."""
    shared = template_texts(slots)
    bitmap = slots.sparkSession.sparkContext.broadcast(key_bitmap(shared, "token"))

    def run(batch):
        row, body, tokens, chars = (batch.column(c) for c in range(4))
        n = tokens.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        of = np.repeat(np.arange(len(n)), n)
        token, size = tokens.flatten().to_numpy(zero_copy_only=False), chars.flatten().to_numpy(zero_copy_only=False)
        p = np.arange(len(of)) - (np.cumsum(n) - n)[of]
        total = np.bincount(of, weights=size, minlength=len(n)).astype(np.int64)
        hit = in_bitmap(bitmap.value, token.view(np.uint64))
        at = of[hit]
        out = {"row": row.to_numpy()[at], "body": body.to_numpy()[at], "p": p[hit].astype(np.int32), "token": token[hit], "chars": size[hit].astype(np.int64), "n": n[at],
               "total": total[at]}
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in out.values()], list(out))

    hits = mapped(slots.select("row", "body", "token", "chars"), run, "row long, body long, p int, token long, chars long, n long, total long")
    hits = written(hits.join(shared, "token"), "hits")
    # edited copies share more than they differ in, by blocks and by characters
    once = hits.dropDuplicates(["body", "p"])
    alike = once.groupBy("body").agg(((F.count("*") * 2 > F.first("n")) & (F.sum("chars") * 2 > F.first("total"))).alias("alike"))
    weak = once.filter(WEAK).select("token", "body").distinct().join(alike, "body")
    copied = weak.groupBy("token").agg(F.count(F.when(F.col("alike"), 1)).alias("a"), F.count("*").alias("n")).filter("2 * a >= n").select("token")
    return written(hits.join(copied, "token", "left_anti").groupBy("row").agg(F.collect_set("p").alias("drop")), "template")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id_col, url_col, text, n_chars) for every row of ``pages``.

    The blocks of ``article`` or ``main`` elements are joined in page order by a line break; a page without such an element gives all its blocks. Template
    texts of the host are taken out of both. Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are left out
    by element, role, class or id. A null or empty page has an empty text. Unclosed and wrongly nested elements are read as browsers do. Repeated rows give
    equal rows; other columns are ignored; an empty table gives an empty result.
    """
    slots = parsed(pages, id_col, url_col, html_col)
    out = slots.select("row", "i", "u", "text").join(template_blocks(slots), "row", "left")
    left = F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.filter("text", lambda x, p: ~F.array_contains("drop", p)))
    out = out.select("i", "u", F.array_join(left, "\n").alias("text"))
    return out.select(F.col("i").alias(id_col), F.col("u").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))
