"""Features of HTML pages: one Arrow UDF parses, everything derived from links is native."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from strandline.functions import batches, urls

MAX_LINK = 2048
_NAME = re.compile(r"[a-zA-Z0-9]{1,100}")
_TEXTS, _LISTS = ("title", "lang", "first_paragraph", "text", "canonical", "refresh"), ("links", "images", "elements", "licenses")
FEATURES = StructType([*[StructField(n, StringType()) for n in _TEXTS], *[StructField(n, ArrayType(StringType())) for n in _LISTS], StructField("meta", MapType(StringType(), StringType()))])
_BREAKS = {"p", "div", "br", "li", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "tr", "table", "article", "section", "nav", "header", "footer", "title"}


class _Features(HTMLParser):
    """Tags inside script and style count like any others; their text doesn't."""

    CDATA_CONTENT_ELEMENTS = ()
    RCDATA_CONTENT_ELEMENTS = ()

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.links: list[str] = []
        self.images: list[str] = []
        self.elements: set[str] = set()
        self.licenses: list[str] = []
        self.title: list[str] | None = None
        self.paragraph: list[str] | None = None
        self.first: str | None = None
        self.text: list[str] = []
        self.lang = self.canonical = self.refresh = None
        self.meta: dict[str, str] = {}
        self.hidden = 0
        self.in_title = False

    def set_cdata_mode(self, elem, **_):  # tags in scripts stay tags
        pass

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if _NAME.fullmatch(tag):
            self.elements.add(tag.lower())
        if tag in ("link", "meta"):
            key = "rel" if tag == "link" else "name"
            self.elements.add(f"{tag}/@{key}={a.get(key, '')}")
        if tag == "meta" and (named := (a.get("name") or a.get("property") or "").strip().lower()) and a.get("content"):
            self.meta.setdefault(named, a["content"])
        rel = a.get("rel", "").lower().split()
        if tag == "html" and a.get("lang"):
            self.lang = self.lang or a["lang"]
        if tag == "a" and "href" in a:
            self.links.append(a["href"])
        if tag in ("a", "link", "area") and "license" in rel and a.get("href"):
            self.licenses.append(a["href"])
        if tag == "link" and "canonical" in rel and a.get("href"):
            self.canonical = self.canonical or a["href"]
        if tag == "meta" and a.get("http-equiv", "").lower() == "refresh":
            m = re.search(r"url\s*=\s*['\"]?([^'\"\s]+)", a.get("content", ""), re.I)
            self.refresh = self.refresh or (m and m[1])
        if tag in ("body", "table", "td") and a.get("background"):
            self.images.append(a["background"])
        if tag == "img" and a.get("src"):
            self.images.append(a["src"])
        if tag in ("img", "source") and a.get("srcset"):
            self.images += [s.split()[0] for s in a["srcset"].split(",") if s.strip()]
        if tag in _BREAKS:
            self.text.append("\n")
        if tag in ("script", "style"):
            self.hidden += 1
        if tag == "title" and self.title is None:
            self.title, self.in_title = [], True
        if tag == "p" and self.first is None:
            self.paragraph = []

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.hidden = max(0, self.hidden - 1)
        if tag == "title":
            self.in_title = False
        if tag == "p" and self.paragraph is not None:
            self.first = "".join(self.paragraph).strip() or None
            self.paragraph = None
        if tag in _BREAKS:
            self.text.append("\n")

    def handle_data(self, data):
        if self.in_title:
            self.title.append(data)
        if self.hidden:
            return
        self.text.append(data)
        if self.paragraph is not None:
            self.paragraph.append(data)


def parse(html: str, base: str | None, normalise: bool = False) -> dict:
    """The features of a page; links and images are absolute where base is a url."""
    p = _Features()
    try:
        p.feed(html)
        p.close()
    except (AssertionError, ValueError):  # a page the parser gives up on keeps what was found
        pass

    def absolute(found: list[str]) -> list[str]:
        out = []
        for link in found:
            link = link.strip()
            if link.startswith("data:"):
                continue
            full = urls.resolve(base, link.replace(" ", "%20"), normalise) if base else link
            if full:
                out.append(full.replace("/../", "/"))
        return list(dict.fromkeys(out))

    text = re.sub(r"[ \t]+", " ", re.sub(r"\s*\n\s*", "\n", "".join(p.text))).strip()
    title = "".join(p.title).strip() if p.title else None
    return {"title": title, "lang": p.lang, "links": absolute(p.links), "images": absolute(p.images), "elements": sorted(p.elements), "licenses": p.licenses, "first_paragraph": p.first, "text": text, "canonical": p.canonical, "refresh": p.refresh, "meta": p.meta}


def _parsed(html: pa.Array, base: pa.Array, normalise: bool, names: tuple[str, ...]) -> pa.Array:
    """The named features; only one run of pages is held as Python objects, the others in Arrow."""
    kind = to_arrow_type(StructType([FEATURES[n] for n in names]))
    done = []
    for first, end in batches.runs(html):
        columns: list[list] = [[] for _ in names]
        for h, b in zip(html[first:end].to_pylist(), base[first:end].to_pylist(), strict=True):
            page = parse(h, b, normalise) if h is not None else {}
            for n, c in zip(names, columns, strict=True):
                v = page.get(n)
                c.append(list(v.items()) if isinstance(v, dict) else v)
        done.append(pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)], fields=list(kind)))
    return pa.concat_arrays(done) if done else pa.array([], kind)


def _udf(normalise: bool, names: tuple[str, ...]):
    @F.arrow_udf(StructType([FEATURES[n] for n in names]))
    def parsed(html: pa.Array, base: pa.Array) -> pa.Array:
        return _parsed(html, base, normalise, names)

    return parsed.asNondeterministic()  # else a filter on what was found has pages parsed twice


#: All features of a page in one pass; null html has none.
features = _udf(False, tuple(FEATURES.names))
#: The same with links in their canonical form.
normalised_features = _udf(True, tuple(FEATURES.names))


def feature(name: str, html: Column | str, base: Column | str) -> Column:
    """One feature alone; no other leaves Python."""
    return _udf(False, (name,))(html, base)[name]


def native_hrefs(html: Column) -> Column:
    """href of each double-quoted anchor, by expression alone."""
    return F.regexp_extract_all(html, F.lit(r"<a [^>]*?href=\"([^\"]*)\""), F.lit(1))


def native_title(html: Column) -> Column:
    return F.trim(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


def native_tags(html: Column) -> Column:
    """Distinct names of start tags in order."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(html, F.lit(r"<([a-zA-Z][a-zA-Z0-9]*)"), F.lit(1)), F.lower)))


def capped(links: Column) -> Column:
    """Links up to the longest length, no inline data."""
    return F.filter(links, lambda u: (F.length(u) <= MAX_LINK) & ~u.startswith("data:"))


def link_hosts(links: Column) -> Column:
    hosts = F.transform(links, lambda u: urls.canonical_host(urls.extract_host(u)))
    return F.array_distinct(F.filter(hosts, lambda h: h.isNotNull() & (h != urls.MALFORMED) & (h != "")))


def link_surts(hosts: Column) -> Column:
    return F.array_distinct(F.flatten(F.transform(hosts, urls.host_surts)))


def link_domains(hosts: Column, suffixes: frozenset[str] = frozenset()) -> Column:
    return F.array_distinct(F.transform(hosts, lambda h: urls.domain(h, suffixes)))


def link_suffixes(hosts: Column, suffixes: frozenset[str] = frozenset()) -> Column:
    return F.array_distinct(F.filter(F.transform(hosts, lambda h: urls.public_suffix(h, suffixes)), lambda s: s.isNotNull()))
