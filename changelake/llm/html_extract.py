r"""Main text of web pages by wrappers learnt from each host's pages.

A wrapper is a union-free regular expression over tokens: tags, text slots (``#``), groups
that may repeat ``(...)+`` and groups that may be missing ``(...)?``.  It is inferred from
token streams of one host by aligning them one after the other: where tags differ, the
mismatch becomes a repeated group if the part beside it is another turn of what came before,
else an optional group; where texts differ, the slot is variable, and a text that is the same
on every page stays constant.

Every task infers wrappers of the hosts it meets from its own pages; the partial wrappers, a
few tokens each, are merged per host by the same alignment, as a tree: those of ``FAN`` tasks by
one task, and so on.  So all pages take part, no page text is shuffled, and a host with a third of
all pages never has more than ``FAN`` tasks' wrappers in one.  What reading needs of a wrapper
(names of template texts, paths) is then joined to the pages by host.

Every slot carries what the host's pages say about it: its text as long as it is the same
everywhere, up to ``ENOUGH`` hashes of distinct pages that have it (so ``ENOUGH`` distinct
pages are told exactly, in whatever order parts are merged), and its greatest length.  A slot
of that many distinct pages is decided by them: a constant text is template and goes, also
within the content container and a repeated group that is the same everywhere (a menu); a
variable one of neutral name is main text.  Adverts, notices, reader comments, menus and the like
vary from page to page by nature, so variation says nothing about them: class and id names that
say so (``NEVER``) and elements and roles that HTML defines as not main text (nav, footer, aside,
form, hidden ...) always stay out.  The other names (share, widget, banner ...) also stand on
containers of stories; they are overruled only where such a container holds more than half of the
host's variable text.  Pages that differ in no other text count once, so copies of a page are no template; if a
host's constant texts outweigh its variable ones (copies with another date), names decide.
If a content container (article, main) holds the greater part of the decided text, or of a
host with too few pages any text, the open slots are those inside it.  A page without any such
slot (of another make than its host's other pages) is read by the same rules over its own tags.

Text rules: character references are decoded, white space inside a block becomes one space,
blocks are joined by a line break in page order.  Unclosed and misnested tags are closed as
their parents close.

Defined results: a null or empty page has the empty text; a page without markup is its text;
an address without a host belongs to the empty host; repeated rows are returned as they are.
"""

from __future__ import annotations

import difflib
import hashlib
import html
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_slices, materialize, pick

# Element names of HTML and words of class names, by their meaning here.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
RAW = set("script style textarea title noscript iframe template svg".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup "
             "time tt u var wbr img br script style noscript template svg iframe button select option textarea input label".split())
NOT_MAIN = set("nav footer aside form script style noscript iframe template svg button select option textarea dialog menu head title".split())
CONTENT = ("article", "main")
# of these, names that nothing overrules
NEVER = set(
    "nav navbar navigation menu breadcrumb breadcrumbs footer sidebar aside notice notices cookie cookies consent ad ads advert adverts "
    "advertisement sponsor sponsored newsletter comment comments respond replies disqus pagination pager copyright adbox adslot "
    "adsbygoogle advertising sponsors cookiebar gdpr".split())
# words that turn a name into a remark on the page (comments-open, no-sidebar)
REMARK = set("has no not without with open closed free enabled disabled off".split())
COMMENT = set("comment comments reply replies".split())
BOILERPLATE = set(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside widget notice notices cookie cookies consent "
    "banner popup modal alert ad ads advert adverts advertisement sponsor sponsored promo promotion newsletter subscribe signup login "
    "share sharing social comment comments respond replies disqus related recommended pagination pager toolbar topbar copyright adbox "
    "adslot adsbygoogle advertising sponsors cookiebar gdpr overlay search searchbox skip".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
ENOUGH = 5  # distinct pages of a host that decide a slot
FAN = 32    # tasks whose wrappers of a host are merged by one
HOST = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"
SPACE = re.compile(r"\s+")


def attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(next((x for x in m.groups()[1:] if x is not None), "")) for m in ATTR.finditer(raw)}


def boilerplate_name(attrs: dict[str, str]) -> int:
    """2 if the element is not shown, or its role, class or id says for sure that it is not main text, 1 if a name may say so, else 0."""
    words = named_words(attrs)
    unseen = "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", "").lower()
    if unseen or attrs.get("role", "").lower() in ROLES or words & NEVER:
        return 2
    return int(bool(words & BOILERPLATE))


def named_words(attrs: dict[str, str]) -> set[str]:
    """Words of class and id names, but for names that only remark on something."""
    names = (set(re.split(r"[^a-z]+", n)) for n in f"{attrs.get('class', '')} {attrs.get('id', '')}".lower().split())
    return {w for words in names if not words & REMARK for w in words}


def stream(page: str) -> Iterator[tuple[str, str, dict[str, str]]]:
    """(kind, value, attributes) with kind open, close or text; raw elements give no text."""
    at, n = 0, len(page)
    while at < n:
        m = TOKEN.search(page, at)
        if m is None:
            yield "text", page[at:], {}
            return
        if m.start() > at:
            yield "text", page[at:m.start()], {}
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            yield "close", tag, {}
            continue
        yield "open", tag, attributes(m[3]) if m[3].strip(" /") else {}
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[^>]*>", re.I).search(page, at)
            at = end.end() if end else n
            yield "close", tag, {}


# An open element of the second kind ends where one of the first begins.
ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}}
CLOSE_P = set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split())


def blocks(page: str) -> list[tuple[tuple[str, ...], int, str]]:
    """(path, skipped, text) of every block of text, in page order.

    The path lists the open block elements with their classes; skipped is 2 if one of
    the elements open there is not main text by its kind or role, 1 if by a class or id, else 0.
    """
    stack: list[tuple[str, str, int]] = []  # tag, label, not main text
    out: list[tuple[tuple[str, ...], int, str]] = []
    parts: list[str] = []
    place: list[tuple[tuple[str, ...], int]] = []

    def here() -> tuple[tuple[str, ...], int]:
        return tuple(x[1] for x in stack if x[0] not in INLINE), max((x[2] for x in stack if x[0] not in INLINE), default=0)

    def flush() -> None:
        text = SPACE.sub(" ", html.unescape("".join(parts))).strip()
        if text:
            out.append((*place[0], text))
        parts.clear()
        place.clear()

    for kind, value, attrs in stream(page):
        if kind == "text":
            if not any(x[2] for x in stack if x[0] in INLINE):  # a button or the like within a sentence
                if not place:
                    place.append(here())
                parts.append(value)
            continue
        if value not in INLINE:
            flush()
        if kind == "open":
            if value in VOID:
                if value == "br" and place:
                    parts.append(" ")
                continue
            shut = ENDS.get(value, set()) | ({"p"} if value in CLOSE_P else set())
            while shut and any(x[0] in shut for x in stack):
                # only within the nearest block that is no such element
                k = max(i for i, x in enumerate(stack) if x[0] in shut)
                if any(x[0] not in INLINE for x in stack[k + 1:]):
                    break
                del stack[k:]
            inside_article = any(x[0] in CONTENT for x in stack)
            # a header inside the article holds its heading
            bad = 2 if value in NOT_MAIN or (value == "header" and not inside_article) else boilerplate_name(attrs)
            if value in CONTENT or value in ("html", "body"):
                bad = 2 if value == "article" and named_words(attrs) & COMMENT else 0
            label = value + "".join("." + c for c in sorted(attrs.get("class", "").lower().split()))
            stack.append((value, label, bad))
        else:
            k = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == value), None)
            if k is not None:
                del stack[k:]
    flush()
    return out


# -- wrappers ---------------------------------------------------------------------------
# A wrapper is a list of nodes: ["t", path, skipped, text or None, pages, length] is a slot
# (None: the text varies; pages: hashes of up to ENOUGH distinct ones), ["+", nodes] a repeated
# group, ["?", nodes] an optional one.  The text of a repeated slot names all its turns' texts.


def tokens(page: str) -> list:
    found = blocks(page)
    # what may be main text tells pages apart
    name = _name(*(x for path, skipped, text in found if skipped < 2 for x in ("/".join(path), text)))[:13]
    return collapse([["t", "/".join(path), skipped, text, [name], len(text)] for path, skipped, text in found])


def _name(*texts: str) -> str:
    h = hashlib.blake2b(digest_size=16)
    for t in texts:
        h.update(t.encode("utf-8", "surrogatepass") + b"\0")
    return h.hexdigest()


def shape(node: list):
    """What must agree for two nodes to be aligned: everything but texts."""
    return (node[0], node[1], node[2]) if node[0] == "t" else (node[0], tuple(shape(n) for n in node[1]))


def merge_nodes(a: list, b: list) -> list:
    """The node of other pages: a text that differs varies."""
    if a[0] == "t":
        pages = a[4] if len(a[4]) >= ENOUGH else [*a[4], *(x for x in b[4] if x not in a[4])][:ENOUGH]
        return [*a[:3], a[3] if a[3] == b[3] else None, pages, max(a[5], b[5])]
    return [a[0], [merge_nodes(x, y) for x, y in zip(a[1], b[1])]]


def next_turn(a: list, b: list) -> list:
    """The node of a further turn on the same page; members (if any) are positions of blocks."""
    if a[0] == "t":
        if len(a) > 6:
            a[6].extend(b[6])
        return [*a[:3], "\0" + _name(a[3], b[3]), a[4], a[5] + b[5], *a[6:]]
    return [a[0], [next_turn(x, y) for x, y in zip(a[1], b[1])]]


def collapse(nodes: list, longest: int = 4) -> list:
    """Turn neighbouring equal parts of up to ``longest`` nodes into repeated groups."""
    for size in range(1, longest + 1):
        out: list = []
        i = 0
        shapes = [shape(n) for n in nodes]
        while i < len(nodes):
            group = nodes[i:i + size]
            if size == 1 and group[0][0] == "+":
                # further turns of a group of one
                if out and out[-1][0] == "+" and shape(out[-1]) == shapes[i]:
                    out[-1] = next_turn(out[-1], group[0])
                else:
                    out.append(group[0])
                i += 1
                continue
            k = i + size
            turns = 1
            while len(group) == size and shapes[k:k + size] == shapes[i:i + size]:
                group = [next_turn(a, b) for a, b in zip(group, nodes[k:k + size])]
                turns += 1
                k += size
            if turns > 1:
                out.append(["+", group])
                i = k
            elif size == 1 and out and out[-1][0] == "+" and len(out[-1][1]) == 1 and shape(out[-1][1][0]) == shapes[i]:
                out[-1] = ["+", [next_turn(out[-1][1][0], nodes[i])]]
                i += 1
            else:
                out.append(nodes[i])
                i += 1
        nodes = out
    return nodes


def bare(node: list) -> list:
    return bare(node[1][0]) if node[0] in "+?" and len(node[1]) == 1 else node


def _partners(a: list, b: list, most_cells: int = 1_000_000) -> dict[int, int]:
    """A longest common alignment: positions of ``a`` to positions of ``b``.

    Very long streams are aligned by their longest common stretches instead, which may
    leave more of them optional but needs no table of all pairs of positions.
    """
    if len(a) * len(b) > most_cells:
        number: dict = {}
        x, y = ([number.setdefault(s, len(number)) for s in z] for z in (a, b))
        same = difflib.SequenceMatcher(None, x, y, autojunk=False).get_matching_blocks()
        return {i + k: j + k for i, j, size in same for k in range(size)}
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = {}, 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out[i], i, j = j, i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def align(a: list, b: list) -> list:
    """The wrapper of everything that ``a`` or ``b`` match, by a longest common alignment.

    Nodes agree if their shapes do, a group of one also with its single node; what has no
    partner becomes optional.
    """
    n, m = len(a), len(b)
    sa, sb = [shape(bare(x)) for x in a], [shape(bare(x)) for x in b]
    partner = _partners(sa, sb)

    def missing(node: list) -> list:
        return node if node[0] == "?" else ["?", [node]]

    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and partner.get(i) == j:
            both = merge_nodes(bare(a[i]), bare(b[j]))
            kinds = {x[0] for x in (a[i], b[j])} | {x[1][0][0] for x in (a[i], b[j]) if x[0] == "?"}
            if "+" in kinds and both[0] == "t":
                both = ["+", [both]]
            out.append(["?", [both]] if "?" in (a[i][0], b[j][0]) else both)
            i, j = i + 1, j + 1
        elif i < n and i not in partner:
            out.append(missing(a[i]))
            i += 1
        else:
            out.append(missing(b[j]))
            j += 1
    return out


def learn(wrapper: list | None, page: list) -> list:
    return page if wrapper is None else align(wrapper, page)


def slots(wrapper: list) -> Iterator[list]:
    for node in wrapper:
        if node[0] == "t":
            yield node
        else:
            yield from slots(node[1])


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper) with the wrapper as JSON, from all pages (host, html)."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list] = {}
        seen: dict[str, dict] = {}

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(known), pa.string()), pa.array([json.dumps(w) for w in known.values()], pa.string())],
                                              names=["host", "wrapper"])

        for b in in_slices(batches):
            for host, page in zip(b.column("host").to_pylist(), b.column("html")):
                nodes = tokens(page.as_py() or "")
                # a text that differs from page to page is one slot: most pages add nothing new
                key = json.dumps([shape(n) for n in nodes])
                before = seen.setdefault(host, {}).get(key)
                if before is not None:
                    nodes = [merge_nodes(x, y) for x, y in zip(before, nodes)]
                    if nodes == before:
                        continue
                seen[host][key] = nodes
                known[host] = learn(known.get(host), nodes)
                if sum(map(len, seen.values())) > 5_000:
                    yield out()
                    known, seen = {}, {}
        yield out()

    def merge(key, table):  # hints here would be read as the kind of function
        wrapper = None
        for w in sorted(table.column("wrapper").to_pylist()):
            wrapper = learn(wrapper, json.loads(w))
        return pa.table({"host": [key[0].as_py()], "part": [key[1].as_py()], "wrapper": [json.dumps(wrapper)]},
                        schema=pa.schema([("host", pa.string()), ("part", pa.int64()), ("wrapper", pa.string())]))

    parts = pages.select("host", "html").mapInArrow(partial, "host string, wrapper string")
    parts = materialize(parts.withColumn("part", F.spark_partition_id().cast("bigint")), "wrapper-parts")
    most = parts.agg(F.max("part")).first()[0] or 0
    while True:
        most //= FAN
        group = F.expr(f"part div {FAN}") if most else F.lit(0).cast("bigint")
        merged = parts.select("host", "wrapper", group.alias("part")).groupBy("host", "part").applyInArrow(merge, "host string, part bigint, wrapper string")
        if not most:
            return merged.drop("part")
        parts = materialize(merged, "wrapper-parts")


class Extractor:
    """Reads pages of one host: keeps what stands in the wrapper's slots of main text."""

    def __init__(self, wrapper: list):
        found = [s for s in slots(wrapper) if s[2] < 2]
        decided = [s for s in found if len(s[4]) >= ENOUGH]
        varied = [s for s in decided if s[3] is None]
        if sum(s[5] for s in varied) < sum(s[5] for s in decided if s[3] is not None and not s[2]):
            decided = varied = []  # rather copies of one page than pages of one template
        #: names of (path, text) of the host's template
        self.template = {_name(s[1], s[3]) for s in decided if s[3] is not None}
        #: paths that are text in spite of a name: their container holds the greater part of what varies
        by_container: dict[str, list] = {}
        for s in varied:
            if s[2]:
                by_container.setdefault(self._named_container(s[1]), []).append(s)
        total = sum(s[5] for s in varied)
        self.named = {s[1] for group in by_container.values() if 2 * sum(s[5] for s in group) > total for s in group}
        text = [s for s in found if (s[3] is None or _name(s[1], s[3]) not in self.template) and (not s[2] or s[1] in self.named)]
        # the container that holds main text on the host's pages
        self.container = None
        for c in CONTENT:
            inside = sum(s[5] for s in varied if self._inside(s[1], c))
            if 2 * inside > sum(s[5] for s in varied) if varied else any(self._inside(s[1], c) for s in text):
                self.container = c
                break
        self.main = {s[1] for s in text if self.container is None or self._inside(s[1], self.container)}

    def facts(self) -> str:
        """What reading pages needs, as JSON."""
        return json.dumps([sorted(self.template), sorted(self.named), self.container, sorted(self.main)])

    @classmethod
    def of_facts(cls, facts: str) -> Extractor:
        e = cls.__new__(cls)
        template, named, e.container, main = json.loads(facts)
        e.template, e.named, e.main = set(template), set(named), set(main)
        return e

    @staticmethod
    def _named_container(path: str) -> str:
        """The path up to its first element with a doubtful class; all of it where an id has the name."""
        steps = path.split("/")
        for i, step in enumerate(steps):
            if named_words({"class": " ".join(step.split(".")[1:])}) & BOILERPLATE:
                return "/".join(steps[:i + 1])
        return path

    @staticmethod
    def _inside(path: str, container: str) -> bool:
        return any(x.split(".")[0] == container for x in path.split("/"))

    def text(self, page: str) -> str:
        read = blocks(page)
        drop: set[int] = set()
        if self.template:
            nodes = collapse([["t", "/".join(path), skipped, text, (), 0, [i]] for i, (path, skipped, text) in enumerate(read)])
            drop = {i for s in slots(nodes) if _name(s[1], s[3]) in self.template for i in s[6]}
        found = [("/".join(path), text) for i, (path, skipped, text) in enumerate(read)
                 if i not in drop and (not skipped or (skipped == 1 and "/".join(path) in self.named))]
        main = self.main
        if found and not any(path in main for path, _ in found):
            # a page of another make than its host's: the container it has itself, or all of it
            own = next((c for c in CONTENT if any(self._inside(path, c) for path, _ in found)), None)
            main = {path for path, _ in found if own is None or self._inside(path, own)}
        return "\n".join(text for path, text in found if path in main)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of (page_id, url, html)."""
    pages = pick(pages, "page_id", "url", "html").withColumn("host", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), HOST, 1)))

    def facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_slices(batches):
            read = [Extractor(json.loads(w.as_py())).facts() for w in b.column("wrapper")]
            yield pa.RecordBatch.from_arrays([b.column("host"), pa.array(read, pa.string())], names=["host", "facts"])

    wrappers = materialize(infer_wrappers(pages).mapInArrow(facts, "host string, facts string"), "wrappers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built: dict[str, Extractor] = {}
        for b in in_slices(batches):
            out = []
            for known, page in zip(b.column("facts").to_pylist(), b.column("html")):
                if known not in built:
                    if len(built) > 2_000:
                        built.clear()
                    built[known] = Extractor.of_facts(known)
                out.append(built[known].text(page.as_py() or ""))
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return pages.join(wrappers, "host").select("page_id", "url", "html", "facts").mapInArrow(
        run, "page_id bigint, url string, text string, n_chars bigint")
