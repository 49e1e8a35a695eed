"""The whole query against a slow extractor of its own: the standard library's parser
and text positions instead of trees, wrappers and places."""
import re
from html.parser import HTMLParser

from barlake.llm import html_extract, registry
from conftest import SF_SMALL

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class Slow(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.out, self.bare, self.any = [], [], [], False

    def skipped(self, tag, attrs):
        a = {k: v or "" for k, v in reversed(attrs)}
        words = {w.lower() for k in ("class", "id", "role") for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+", a.get(k, ""))}
        marks = html_extract.MARKS if tag not in ("article", "main", "html", "body") else {"comment", "comments"} if tag in ("article", "main") else set()
        return (tag in html_extract.NO_ARTICLE or "hidden" in a or a.get("aria-hidden") == "true" or bool(words & marks)
                or "display:none" in a.get("style", "").replace(" ", "")
                or tag == "header" and not any(t in ("article", "main") for t, _ in self.open))

    def space(self, tag):
        if tag in html_extract.BLOCK:
            self.out.append(" ")
            self.bare.append(" ")

    def handle_starttag(self, tag, attrs):
        self.space(tag)
        if tag == "p" or tag == "li":
            while self.open and self.open[-1][0] == tag:
                self.open.pop()
        if tag not in VOID:
            skip = self.skipped(tag, attrs)
            self.open.append((tag, skip))
            self.any |= tag in ("article", "main") and not any(s for _, s in self.open)

    def handle_endtag(self, tag):
        self.space(tag)
        names = [t for t, _ in self.open]
        if tag in names:
            del self.open[len(names) - 1 - names[::-1].index(tag):]

    def handle_data(self, data):
        if not any(s for _, s in self.open):
            self.bare.append(data)
            if any(t in ("article", "main") for t, _ in self.open):
                self.out.append(data)


def slow(page):
    p = Slow()
    p.feed(page or "")
    p.close()
    return " ".join("".join(p.out if p.any else p.bare).split())


def test_all_pages_agree(spark):
    for folder in (SF_SMALL, SF_SMALL.replace("0.001", "0.01")):
        pages = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
        got = registry.QUERIES["op6_html_extraction"](spark, folder).collect()
        assert len(got) == len(pages) and all(r.n_chars == len(r.text) for r in got)
        other = [r.page_id for r in got if r.text != slow(pages[r.page_id])]
        assert not other, (len(other), other[:5])
