"""HTML extraction by template deduction from equivalence classes.

Pages of one host share a template. Its tokens - tags by their path, and whole text runs by path and content - occur equally often on
each page, so their occurrence vectors over the host's pages are equal. A vector is kept as its number of pages, its
sum, and an exclusive or of hashes of (page, count): a sum that tasks can add up in any order, so no host is ever gathered,
however many pages it has. Tokens with equal vectors are an equivalence class. A class on enough of the host's pages
whose paths hang below paths of the template is nested into it. Text runs of the template are its fixed
words; the other places of text are slots.

From a page, the slots remain whose runs don't repeat from page to page, of those below a main element if the page has one.
Menus, headers, footers, sidebars, notices, adverts, forms and comments go by the names of their elements, and by repeating.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starfold.llm.tables import stored
from starfold.llm.text import portions, put, strings, whole

# Names of elements and words of classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg math select".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img br".split())
MAIN = frozenset(["article", "main"])
APART = frozenset("head nav header footer aside form script style noscript iframe template svg math select textarea button menu dialog title object canvas audio video".split())
HEADER = frozenset(["header"])
APART_WORDS = frozenset("ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer login masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted related respond share sharing sidebar social sponsored subscribe toolbar widget".split())
#: What may stand beside such a word in the name of one class: "site-footer" is a footer, "has-sidebar" no sidebar.
BESIDE = frozenset("area bar block bottom box container global inner item left list main outer right section site top wrap wrapper".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: What an opening tag ends if it is open.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^<>]*)(?:>|\Z)|[^<]+|<""", re.S)
NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
#: Levels of nesting that a path tells apart; deeper elements share the path of their ancestor.
LEVELS = 48
#: Paths below a main element.
IN_MAIN = r"/(article|main)([./]|$)"
#: Places in which the tokens of one host meet what is known of the host.
SALTS = 16


@dataclass
class Page:
    """tags: how often each path opens and closes; blocks: (path, inside a main element, apart by its names, text)."""

    tags: dict[str, int] = field(default_factory=dict)
    blocks: list[tuple[str, bool, bool, str]] = field(default_factory=list)


def _named(attributes: str) -> tuple[str, list[str]]:
    """The class names for a path, digits left out, and the names in class, id and role, each in its words."""
    if "=" not in attributes:
        return "", []
    path, names = "", []
    for kind, *values in NAMES.findall(attributes):
        value = "".join(values).lower()
        names += [words for name in value.split() if (words := re.findall(r"[a-z]+", name))]
        if kind.lower() == "class":
            path = "." + ".".join(sorted(re.sub(r"\d+", "", value).split()))
    return path, names


def _speaks(names: list[list[str]], words: frozenset[str]) -> bool:
    """Whether a whole name, not just a part of it, says one of the words."""
    return any(not words.isdisjoint(name) and all(w in words or w in BESIDE for w in name) for name in names)


def parse(source: str) -> Page:
    """Tags and blocks of a page. Broken markup is read as far as it can be: open elements end with their parent, an
    unfinished tag at the end is markup.

    Names of classes never set html or body apart, nor what holds the main element: if all main elements are apart by names (or
    in a form) alone and hold more text than the rest of the page, they aren't apart."""
    page = Page()
    # name, path, in main, apart: 1 by a name or a form outside of main elements, 2 otherwise
    stack: list[tuple[str, str, bool, int]] = [("", "", False, 0)]
    run: list[str] = []
    place = stack[0]
    at, end = 0, len(source)

    def flush() -> None:
        nonlocal run
        if run:
            text = " ".join("".join(run).split())
            if text:
                page.blocks.append((place[1], place[2], place[3], text))
            run = []

    def count(path: str) -> None:
        page.tags[path] = page.tags.get(path, 0) + 1

    def end_of(name: str) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] == name:
                for closed in stack[i:]:
                    count(closed[1] + "/")
                del stack[i:]
                return

    while at < end:
        m = TOKEN.match(source, at)
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            if source[m.start()] != "<" or m.end() - m.start() == 1:
                if not run:
                    place = stack[-1]
                run.append(entities.unescape(m[0]))
            continue
        closing, attributes = m[1] or m[4], m[3] or m[6] or ""
        if name in INLINE:
            if name == "br":
                run.append(" ")
                continue
            if closing:
                if any(x[0] == name for x in stack[-3:]):
                    flush()
                    end_of(name)
                continue
            if name in VOID or not _speaks(_named(attributes)[1], APART_WORDS):
                continue
        flush()
        if closing:
            end_of(name)
            continue
        if name in CLOSES_P:
            if any(x[0] == "p" for x in stack[-4:]):
                end_of("p")
        for other in ENDS.get(name, ()):
            if stack[-1][0] == other:
                end_of(other)
        classes, names = _named(attributes)
        parent = stack[-1]
        named = name not in ("html", "body") and (_speaks(names, APART_WORDS) or (not parent[2] and _speaks(names, HEADER)))
        main = parent[2] or name in MAIN or (name in ("div", "section") and (["main"] in names or (not named and any("main" in x for x in names))))
        if parent[3] == 2 or (name in APART and not (name == "header" and parent[2]) and (name != "form" or parent[2])):
            apart = 2
        else:
            apart = 2 if named and parent[2] else 1 if named or name == "form" else parent[3]
        path = f"{parent[1]}/{name}{classes}" if len(stack) <= LEVELS else parent[1]
        count(path)
        if name in RAW and not attributes.endswith("/"):
            close = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(source, at)
            count(path + "/")
            at = close.end() if close else end
        elif name not in VOID and not attributes.endswith("/"):
            stack.append((name, path, main, apart))
    flush()
    held = sum(len(b[3]) for b in page.blocks if b[1] and b[2] == 1)
    free = held and not any(b[1] and not b[2] for b in page.blocks) and held > sum(len(b[3]) for b in page.blocks if not b[2])
    page.blocks = [(path, main, bool(apart) and not (free and main and apart == 1), text) for path, main, apart, text in page.blocks]
    return page


def content_of(page: Page) -> int:
    """What copies of a page share, whatever small texts change around it: a hash of the longest runs that make up three quarters of the text."""
    import xxhash

    runs = sorted((b[3] for b in page.blocks if not b[2]), key=lambda x: (-len(x), x))
    left, held = 0.75 * sum(map(len, runs)), xxhash.xxh3_64()
    for text in runs:
        if left <= 0:
            break
        left -= len(text)
        held.update(text + "\n")
    return held.intdigest() >> 1


def run_hash(text: str) -> int:
    import xxhash

    return (xxhash.xxh3_64_intdigest(text) >> 1) or 1


def host_of(url: Column) -> Column:
    """The lower-cased host and port of an address; empty for null or anything else."""
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://([^/?#]*)", 1), F.lit(""))


def occurrences(pages: DataFrame) -> DataFrame:
    """(host, path, run, pages, total, vector, contents): each token's occurrence vector; run is 0 for tags. pages: (host, name,
    html), name being what tells pages apart. contents is the number of different contents of the pages with the run (of all
    pages, for the path ""; 1 for tags): copies of a page repeat its article, and only other pages show what is template.
    Tokens are counted for a batch of pages before Spark adds up the batches."""
    schema = T.StructType([T.StructField("host", T.StringType()), T.StructField("path", T.StringType()), *(T.StructField(c, T.LongType()) for c in ("run", "content", "pages", "total", "vector"))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in portions(batches, "html"):
            held: dict[tuple[str, str, int, int], list[int]] = {}
            for host, name, source in zip(batch.column("host").to_pylist(), batch.column("name").to_pylist(), strings(batch.column("html")), strict=True):
                page = parse(source)
                content = content_of(page)
                counts = {(host, "", 0, content): 1} | {(host, path, 0, 0): n for path, n in page.tags.items()}
                for path, _, apart, text in page.blocks:
                    if not apart:
                        key = (host, path, run_hash(text), content)
                        counts[key] = counts.get(key, 0) + 1
                for key, n in counts.items():
                    row = held.setdefault(key, [0, 0, 0])
                    row[0] += 1
                    row[1] += n
                    row[2] ^= xxhash.xxh3_64_intdigest(f"{name} {n}") >> 1
            columns = [list(c) for c in zip(*held, strict=True)] + [list(c) for c in zip(*held.values(), strict=True)] if held else [[]] * 7
            kinds = [pa.string(), pa.string(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=schema.names)

    counted = pages.mapInArrow(run, schema)
    added = [F.sum("pages").alias("pages"), F.sum("total").alias("total"), F.bit_xor("vector").alias("vector")]
    return counted.groupBy("host", "path", "run", "content").agg(*added).groupBy("host", "path", "run").agg(*added, F.count("*").alias("contents"))


def templates(tokens: DataFrame, support: float = 0.5, least_pages: int = 10) -> DataFrame:
    """(host, main, drop, fixed): for each host with pages of at least ``least_pages`` different contents, whether its template has
    a main element, the paths whose slots repeat on pages that differ, and the text runs that the template fixes. tokens: what
    ``occurrences`` gives, stored."""
    size = tokens.where((F.col("path") == "") & (F.col("run") == 0)).select("host", F.col("pages").alias("host_pages"), F.col("contents").alias("host_contents")).where(F.col("host_contents") >= least_pages)
    # a host with a third of all pages is joined in SALTS places, and grouped by its tokens, never as a whole
    salted = size.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = tokens.withColumn("salt", F.pmod(F.xxhash64("path", "run"), F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"]).drop("salt").where(F.col("path") != "")
    # equivalence classes on enough pages, of two tokens or more
    frequent = own.where(F.col("pages") >= support * F.col("host_pages"))
    classes = frequent.groupBy("host", "host_pages", "host_contents", "pages", "total", "vector").agg(F.collect_set(F.struct("path", "run", "contents")).alias("members")).where(F.size("members") >= 2)
    members = classes.select("host", "host_contents", "pages", F.explode("members").alias("m")).select("host", "host_contents", "pages", "m.path", "m.run", "m.contents")
    tags = members.where(F.col("run") == 0).select("host", F.regexp_replace("path", "/$", "").alias("path"), "pages").groupBy("host", "path").agg(F.max("pages").alias("pages"))
    # a class is nested into the template if its parent's path is there, on as many pages at least
    parent = tags.select("host", F.col("path").alias("parent"), F.col("pages").alias("parent_pages"))
    up = F.regexp_replace("path", "/[^/]*$", "")
    nested = tags.withColumn("parent", up).join(parent, ["host", "parent"], "left").where((F.col("parent") == "") | (F.col("parent_pages") >= F.col("pages")))
    has_main = nested.where(F.col("path").rlike(r"(^|/)(article|main)[^/]*$")).select("host").distinct().withColumn("main", F.lit(True))
    fixed = members.where((F.col("run") != 0) & (F.col("contents") >= 0.9 * F.col("host_contents")) & (F.col("host_contents") >= 2 * least_pages)).groupBy("host").agg(F.collect_set("run").alias("fixed"))
    runs = own.where(F.col("run") != 0).groupBy("host", "path").agg(F.sum("contents").alias("n"), F.sum(F.when(F.col("contents") >= F.greatest(F.lit(3), 0.02 * F.col("host_contents")), F.col("contents")).otherwise(0)).alias("again"))
    again = runs.where(F.col("again") > 0.5 * F.col("n")).select("host", "path")
    # below a main element only classes nested into the template are dropped, not what some pages have
    inner = again.where(F.col("path").rlike(IN_MAIN)).join(nested.select("host", "path"), ["host", "path"], "left_semi")
    drop = again.where(~F.col("path").rlike(IN_MAIN)).unionByName(inner).groupBy("host").agg(F.collect_set("path").alias("drop"))
    return size.select("host").join(has_main, "host", "left").join(drop, "host", "left").join(fixed, "host", "left")


def main_text(source: str, host_main: bool, drop: frozenset[str], fixed: frozenset[int]) -> str:
    """The blocks of the article, one to a line: those below a main element without the repeated slots of a template that has one,
    else those in slots that don't repeat. A fixed run in a slot of the article, such as an item of a list, is the article's."""
    blocks = [b for b in parse(source).blocks if not b[2]]
    inside = [b for b in blocks if b[1]]
    if inside:
        return "\n".join(b[3] for b in inside if not (host_main and b[0] in drop))
    return "\n".join(b[3] for b in blocks if b[0] not in drop and not (fixed and run_hash(b[3]) in fixed))


def extract(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """The pages with text (the main text, empty if there is none) and n_chars (its code points).

    Defined cases: a null or empty page gives the empty text; a page without url belongs to the empty host; a host of
    under ten different pages has no template, and its pages go by their elements alone; copies of a page show no repetition;
    pages are read whole; columns named text or n_chars are replaced.
    """
    src = pages.select(F.struct("*").alias("row")).select("row", host_of(F.col("row")[url]).alias("host"), whole(F.col("row")[html]).alias("html"))
    tokens = stored(occurrences(src.select("host", F.concat_ws(" ", F.col("row")[url], F.xxhash64("html").cast("string")).alias("name"), "html")), "html-tokens")
    template = stored(templates(tokens), "html-templates")
    kept = put(pages, "row", _html=F.col("html"), _main=F.coalesce("main", F.lit(False)), _drop=F.col("drop"), _fixed=F.col("fixed"))
    joined = src.join(template.withColumnRenamed("host", "of"), F.col("host") == F.col("of"), "left").select(*kept)
    rest = [f for f in joined.schema.fields if f.name not in ("_html", "_main", "_drop", "_fixed", "text", "n_chars")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "_html"):
            columns = (strings(batch.column("_html")), *(batch.column(c).to_pylist() for c in ("_main", "_drop", "_fixed")))
            text = [main_text(s, m, frozenset(d or ()), frozenset(f or ())) for s, m, d, f in zip(*columns, strict=True)]
            own = [pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in rest), *own], names=[*(f.name for f in rest), "text", "n_chars"])

    return joined.mapInArrow(run, T.StructType([*rest, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]))
