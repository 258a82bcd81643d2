"""Main text of web pages: containers are scored per page, paths win by votes per host."""

from __future__ import annotations

import hashlib
import html as html_lib
import re

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructType

from lexmill.llm.common import columns, map_rows
from lexmill.session import write_table

# Element names by their role.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "template"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
DROPPED = RAW | {
    "head", "nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "svg", "object",
}
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "del", "dfn", "em", "font", "i", "ins", "kbd",
    "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u",
    "var", "img", "wbr", "br", "center",
}
CONTAINERS = {"body", "div", "article", "main", "section", "td", "center", "html"}
#: Elements that neither begin nor end a block, though their own text is left out.
WITHIN = INLINE | (RAW - {"title"}) | {"button", "select", "svg", "object"}
#: Dropped elements, besides those dropped by their names, that may turn out to hold the article.
DOUBTFUL = {"form"}
#: Characters outside links from which a page's text may come from an element that was dropped for its name.
ENOUGH_TEXT = 250
#: An open element that a start tag ends, up to the nearest of the listed walls.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Parts of class and id names of what is not the article.
ALWAYS = {
    "ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "nav", "navbar",
    "navigation", "menu", "footer", "cookie", "cookies", "consent", "gdpr", "share", "sharing", "social",
    "related", "recommended", "newsletter", "subscribe", "comment", "comments", "disqus", "replies",
    "breadcrumb", "breadcrumbs", "pagination", "pager", "popup", "modal", "overlay", "signup", "login",
}
UNLESS_CONTENT = {
    "header", "masthead", "sidebar", "aside", "banner", "notice", "notices", "widget", "toolbar", "form",
    "search", "alert", "disclaimer", "copyright", "toc", "tags",
}
CONTENT = {"content", "article", "post", "entry", "story", "main", "body", "text"}
FACTOR = {"article": 1.6, "main": 1.5, "section": 1.1, "div": 1.1, "center": 1.0, "td": 1.0, "body": 0.9, "html": 0.8}
CONTENT_FACTOR = 1.5
#: Containers of a page that vote.
VOTES = 3
#: Characters from which text inside a link is read as text: whole articles may be links.
LONG_LINK = 120
#: Different main texts of a host from which its pages judge a part together.
JURY = 3
#: Words from which a page alone takes a part into its text; labels need the host's voice.
FEW_WORDS = 3

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
#: An attribute and its value in double quotes, in single quotes or bare; a quote that never closes is no quote.
ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|((?!["'])[^\s>]++)|))?+""")
#: What a start tag holds up to its closing sign.
TAG = re.compile(rf"(?:[\s/]++|{ATTRIBUTE.pattern})*+")
READ = {"class", "id", "role", "hidden", "style", "itemprop", "aria-hidden"}
WORD = re.compile(r"[a-z]+")
PARSED = (
    StructType()
    .add("blocks", ArrayType(columns(text="string", part="string").add("inside", ArrayType(IntegerType()))))
    .add("containers", ArrayType(columns(path="string", score="double").add("whole", BooleanType())))
    .add("votes", ArrayType(columns(path="string", weight="double")))
    .add("main", LongType())
    .add("parts", ArrayType(columns(path="string", plain="long", linked="long", words="long", print="long")))
)
#: Hosts and characters up to which the table of winners is sent to every task.
BROADCAST_HOSTS = 200_000
BROADCAST_BYTES = 32 << 20
HOST_SALTS = 64


def tokens(html: str):
    """``("text", s)``, ``("open", name, attributes)`` and ``("close", name)`` in page order.

    Comments, declarations and the contents of raw elements are left out; what is never closed
    runs to the end of the page.
    """
    at, size, low, torn = 0, len(html), None, False
    while at < size:
        mark = html.find("<", at)
        if mark < 0:
            yield ("text", html[at:])
            return
        if mark > at:
            yield ("text", html[at:mark])
        after = html[mark + 1 : mark + 2]
        if html.startswith("<!--", mark):
            end = html.find("-->", mark + 4)
            at = size if end < 0 else end + 3
        elif after in ("!", "?"):
            end = html.find(">", mark)
            at = size if end < 0 else end + 1
        elif after == "/" or after.isalpha():
            name = NAME.match(html, mark + 1 + (after == "/"))
            end = html.find(">", mark)
            # A quoted value may hold the closing sign. A tag that has none outside its values runs to the
            # end of the page; then each tag ends at the first sign, so that a page is not scanned again.
            if name and end >= 0 and not torn and ('"' in (piece := html[mark:end]) or "'" in piece):
                outside = TAG.match(html, name.end()).end()
                torn = outside == size
                end = end if torn else outside
            stop = size if end < 0 else end
            at = stop + 1
            if name is None:
                continue
            tag = name.group().lower()
            if after == "/":
                yield ("close", tag)
                continue
            yield ("open", tag, html[name.end() : stop])
            if tag in RAW and not html[mark:stop].endswith("/"):
                low = low if low is not None else html.lower()
                end = low.find(f"</{tag}", at) if len(low) == size else html.find(f"</{tag}", at)
                at = size if end < 0 else end
        else:
            yield ("text", "<")
            at = mark + 1


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare in ATTRIBUTE.findall(text):
        if (name := name.lower()) in READ:
            found.setdefault(name, double or single or bare)  # of repeated names the first counts
    return found


def _unwanted(tag: str, attributes: dict[str, str]) -> bool:
    """Whether an element is left out for its tag, its state or its role."""
    if tag in DROPPED:
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if re.search(r"display\s*:\s*none", attributes.get("style", ""), re.I):
        return True
    return attributes.get("role", "").lower() in (
        "navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert")


def _ill_named(tag: str, attributes: dict[str, str]) -> bool:
    """Whether the class or id of an element names something other than the article."""
    if not attributes or tag in ("html", "body", "article", "main"):
        parts = set(WORD.findall(attributes.get("class", "").lower())) if attributes and tag == "article" else set()
        return bool(parts & {"comment", "comments", "ad", "advert", "related", "promo"})
    parts = set(WORD.findall(f"{attributes.get('class', '')} {attributes.get('id', '')}".lower()))
    return bool(parts & ALWAYS) or bool(parts & UNLESS_CONTENT and not parts & (CONTENT | {"with", "has"}))


def _step(tag: str, attributes: dict[str, str]) -> str:
    """A path step: the tag and its classes, with numbers made alike."""
    names = sorted({re.sub(r"\d+", "#", c) for c in attributes.get("class", "").lower().split()})
    return ".".join([tag, *names])


class Page:
    """Blocks of a page in order, each with its containers; containers with path and factor.

    Names may mislead: where a page has no text outside links left, the dropped form or ill-named
    element with the most text is read after all, if it holds an article, a main part, a first heading or
    ``ENOUGH_TEXT`` characters, and inside it the same until there is text.
    """

    def __init__(self, html: str):
        self._read(html, set())
        if self._doubts and not any(len(text) > linked for text, linked, _ in self.blocks):
            if forgiven := self._forgiven():
                self._read(html, forgiven)

    def _forgiven(self) -> set[int]:
        """The dropped elements to read: the best outermost one, and the best inside it until one has text of its own."""
        whole = {k: (marked, own) for k, (_, own, marked) in self._doubts.items()}
        inner: dict[int, list[int]] = {}
        for k in sorted(self._doubts, reverse=True):  # inner ones have higher numbers
            inner.setdefault(parent := self._doubts[k][0], []).append(k)
            if parent >= 0:
                whole[parent] = whole[parent][0] or whole[k][0], whole[parent][1] + whole[k][1]
        chosen, at = set(), -1
        while at < 0 or not self._doubts[at][1]:
            at = max(inner.get(at, ()), key=lambda k: (whole[k][0] and whole[k][1] > 0, whole[k][1], -k), default=-1)
            if at < 0:
                break
            if not chosen and whole[at][1] < ENOUGH_TEXT and not (whole[at][0] and whole[at][1]):
                return set()
            chosen.add(at)
        return chosen

    def _read(self, html: str, forgiven: set[int]) -> None:
        self.blocks: list[tuple[str, int, tuple[int, ...]]] = []  # text, characters in links, containers
        self.containers: list[tuple[str, float]] = []
        self._text: list[str] = []
        self._linked = 0
        # Elements dropped for their names: the one around, own characters outside links, own mark of an article.
        self._doubts: dict[int, tuple[int, int, bool]] = {}
        number, doubts, hard, within = -1, [], 0, 0
        # An open element: name, container or -1, unwanted, and whether only for its name.
        stack: list[tuple[str, int, bool, bool]] = []
        inside: list[int] = []
        path: list[str] = []
        unwanted = links = 0
        open_block = False

        def pop():
            nonlocal unwanted, links, hard, within
            tag, container, bad, doubt = stack.pop()
            if doubt:
                doubts.pop()
            hard -= bad and not doubt
            if tag in WITHIN:
                within -= bad
            elif not within:
                self._end(tuple(inside))
            unwanted -= bad
            links -= tag == "a"
            if container >= 0:
                inside.pop()
                path.pop()

        for token in tokens(html):
            if token[0] == "text":
                if not unwanted:
                    self._text.append(token[1])
                    if links and len(token[1]) < LONG_LINK:
                        self._linked += len(token[1])
                elif doubts and not hard and not links:
                    around, own, marked = self._doubts[doubts[-1]]
                    self._doubts[doubts[-1]] = around, own + len(token[1].strip()), marked
            elif token[0] == "open":
                tag = token[1]
                if tag in VOID:
                    if tag == "hr":
                        self._end(tuple(inside))
                    elif not unwanted:
                        self._text.append(" " if tag == "br" else "")
                    continue
                if tag not in WITHIN and not within:
                    self._end(tuple(inside))
                    targets, walls = CLOSES.get(tag, ({"p"}, CONTAINERS | {"table", "button"}))
                    for back in range(len(stack) - 1, -1, -1):
                        if stack[back][0] in walls:
                            break
                        if stack[back][0] in targets:
                            while len(stack) > back:
                                pop()
                            break
                attributes = _attributes(token[2])
                bad, container, doubt = _unwanted(tag, attributes), -1, False
                number += 1
                if tag in DOUBTFUL if bad else _ill_named(tag, attributes):
                    bad = doubt = number not in forgiven
                if doubt:
                    self._doubts[number] = doubts[-1] if doubts else -1, 0, False
                    doubts.append(number)
                elif bad:
                    hard += 1
                if doubts and not hard and tag in ("article", "main", "h1"):
                    self._doubts[doubts[-1]] = *self._doubts[doubts[-1]][:2], True
                if tag in CONTAINERS:
                    container = len(self.containers)
                    path.append(_step(tag, attributes))
                    parts = set(WORD.findall(f"{attributes.get('class', '')} {attributes.get('id', '')}".lower()))
                    good = tag == "div" and parts & CONTENT or attributes.get("itemprop") == "articleBody" or attributes.get("role") == "main"
                    self.containers.append((">".join(path), CONTENT_FACTOR if good else FACTOR[tag]))
                    inside.append(container)
                stack.append((tag, container, bad, doubt))
                unwanted += bad
                within += bad and tag in WITHIN
                links += tag == "a"
            else:
                tag = token[1]
                for back in range(len(stack) - 1, -1, -1):
                    if stack[back][0] == tag:
                        while len(stack) > back:
                            pop()
                        break
                    if stack[back][1] >= 0 and tag in INLINE | {"p", "li"}:
                        break  # a stray end tag does not close the container around it
        self._end(tuple(inside))

    def _end(self, containers: tuple[int, ...]) -> None:
        if self._text:
            text = " ".join(html_lib.unescape("".join(self._text)).split())
            if text:
                self.blocks.append((text, self._linked, containers))
            self._text, self._linked = [], 0

    def scores(self) -> list[float]:
        """Characters outside links in each container, times the factor of its kind."""
        sums = [0.0] * len(self.containers)
        for text, linked, containers in self.blocks:
            for c in containers:
                sums[c] += max(0, len(text) - linked)
        return [s * f for s, (_, f) in zip(sums, self.containers)]

    def whole_paths(self) -> set[str]:
        """Paths whose containers hold all of the best container's text outside links (if any, else all its text)."""
        scores = self.scores()
        best = max(range(len(scores)), key=lambda i: (scores[i], i), default=None)
        if best is None:
            return set()
        around = {
            inside for text, linked, inside in self.blocks
            if best in inside and (len(text) > linked or scores[best] == 0)
        }
        held = [{self.containers[i][0] for i in inside} for inside in around]
        return set.intersection(*held) if held else set()

    def parts(self) -> tuple[list[str | None], int, dict[str, tuple[int, int, int, int]]]:
        """Of each block its part (None in the best container), a print of the main text, and of each part
        its characters outside and inside links, its words and a print of its text.

        A part is what lies beside the best container: the outermost containers of one path that do not hold
        the best one, or the text that stands by itself in a container around it.
        """
        scores = self.scores()
        best = max(range(len(scores)), key=lambda i: (scores[i], i), default=None)
        inner = next((inside for _, _, inside in self.blocks if best in inside), None)
        if inner is None:
            return [None] * len(self.blocks), 0, {}
        around = set(inner[: inner.index(best)])
        of_block: list[str | None] = []
        texts: dict[str | None, list[tuple[str, int]]] = {}
        for text, linked, inside in self.blocks:
            part = None
            if best not in inside:
                own = next((c for c in inside if c not in around), None)
                if own is not None:
                    part = self.containers[own][0]
                else:
                    part = (self.containers[inside[-1]][0] + ">" if inside else "") + "text()"
            of_block.append(part)
            texts.setdefault(part, []).append((text, min(linked, len(text))))
        prints = {part: _print(text for text, _ in held) for part, held in texts.items()}
        return of_block, prints[None], {
            part: (sum(len(t) - n for t, n in held), sum(n for _, n in held), sum(len(t.split()) for t, _ in held), prints[part])
            for part, held in texts.items() if part is not None
        }

    def votes(self) -> list[tuple[str, float]]:
        """The best containers' paths, weighted by their part of the best score."""
        scores = self.scores()
        ranked = sorted(range(len(scores)), key=lambda i: (-scores[i], -i))[:VOTES]
        ranked = [i for i in ranked if scores[i] > 0]
        best = scores[ranked[0]] if ranked else 1.0
        paths: dict[str, float] = {}
        for i in ranked:
            paths[self.containers[i][0]] = max(scores[i] / best, paths.get(self.containers[i][0], 0.0))
        return list(paths.items())


def _print(texts) -> int:
    whole = "\n".join(texts).encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(whole, digest_size=8).digest(), "little", signed=True)


def host_of(url: str) -> Column:
    """Lower-case host of an address, without user and port; empty if there is none."""
    rest = F.regexp_replace(F.coalesce(F.col(url).cast("string"), F.lit("")), r"^.*?://", "")
    authority = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":.*$", ""))


def parse_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``row_id, url, host, blocks, containers, votes, main, parts``: each page parsed once.

    ``blocks`` are ``(text, part, inside)`` with the numbers of the containers around a block,
    ``containers`` are ``(path, score, whole)``, where ``whole`` says that the path's containers hold
    all that the page's best container has outside links, and ``votes`` are ``(path, weight)``. ``main`` is a
    print of the best container's text, ``parts`` are ``(path, plain, linked, words, print)`` of what lies beside it.
    """
    source = pages.select(
        F.col(id_col).alias("row_id"), F.col(url_col).cast("string").alias("url"), host_of(url_col).alias("host"),
        F.col(html_col).cast("string").alias("html"),
    )
    schema = StructType(source.schema.fields[:3] + PARSED.fields)

    def make():
        def apply(ids, urls, hosts, htmls):
            parsed = [Page(h or "") for h in htmls]
            beside = [p.parts() for p in parsed]
            return {
                "row_id": ids, "url": urls, "host": hosts,
                "blocks": [
                    [
                        {"text": text, "part": part, "inside": list(inside)}
                        for (text, _, inside), part in zip(p.blocks, of_block)
                    ]
                    for p, (of_block, _, _) in zip(parsed, beside)
                ],
                "containers": [
                    [
                        {"path": path, "score": score, "whole": path in whole}
                        for (path, _), score in zip(p.containers, p.scores())
                    ]
                    for p in parsed for whole in (p.whole_paths(),)
                ],
                "votes": [[{"path": path, "weight": weight} for path, weight in p.votes()] for p in parsed],
                "main": [main for _, main, _ in beside],
                "parts": [
                    [{"path": k, "plain": v[0], "linked": v[1], "words": v[2], "print": v[3]} for k, v in parts.items()]
                    for _, _, parts in beside
                ],
            }

        return apply

    return map_rows(source, schema, make)


def winning_paths(parsed: DataFrame) -> DataFrame:
    """One row per host: ``host, path`` with the most votes; ties go to the larger path.

    Votes are summed per host and path before they meet, so a host with many pages is no hot key.
    """
    votes = parsed.select("host", F.explode("votes").alias("v")).select("host", "v.path", "v.weight")
    summed = votes.groupBy("host", "path").agg(F.sum(F.col("weight").cast("decimal(20,6)")).alias("weight"))
    return summed.groupBy("host").agg(F.max_by("path", F.struct("weight", "path")).alias("path"))


def judged_parts(parsed: DataFrame) -> DataFrame:
    """``host, path, kept``: what the pages of a host say together of a part beside the article.

    A part is judged where it stands beside ``JURY`` different main texts. It is kept if most of its
    characters are outside links and it is not one text on many pages: its different texts are more than half
    as many as the main texts beside them. Copies of one page are one voice.
    """
    seen = parsed.select("host", "main", F.explode("parts").alias("p")).select("host", "main", "p.*")
    voices = seen.groupBy("host", "path", "main", "print").agg(F.max("plain").alias("plain"), F.max("linked").alias("linked"))
    return (
        voices.groupBy("host", "path")
        .agg(
            F.count_distinct("main").alias("mains"), F.count_distinct("print").alias("texts"),
            F.sum("plain").alias("plain"), F.sum("linked").alias("linked"),
        )
        .where(F.col("mains") >= JURY)
        .select("host", "path", ((F.col("plain") > F.col("linked")) & (2 * F.col("texts") > F.col("mains"))).alias("kept"))
    )


def keep_parts(parsed: DataFrame, judged: DataFrame) -> DataFrame:
    """``parsed`` with ``beside``, the paths of a page's parts that belong to its article.

    Where the host has judged a part, that holds; else a part of ``FEW_WORDS`` is kept if most of it is outside links.
    Only pages with parts join the verdicts; what meets again by page are its few paths.
    """
    own = F.transform(F.filter("parts", lambda p: (p["plain"] > p["linked"]) & (p["words"] >= FEW_WORDS)), lambda p: p["path"])
    if judged.isEmpty():
        return parsed.withColumn("beside", own)
    alone = parsed.where(F.size("parts") == 0).withColumn("beside", own)
    asked = parsed.where(F.size("parts") > 0)
    paths = asked.select("page", "host", F.explode("parts").alias("p")).select("page", "host", "p.path")
    verdicts = by_host(paths, judged, ["host", "path"], "page", "inner").groupBy("page").agg(
        F.collect_list(F.when(F.col("kept"), F.col("path"))).alias("yes"),
        F.collect_list(F.when(~F.col("kept"), F.col("path"))).alias("no"),
    )
    none = F.array().cast("array<string>")
    beside = F.array_union(
        F.array_except(own, F.coalesce("no", none)), F.coalesce("yes", none)
    )
    return alone.unionByName(asked.join(verdicts, "page", "left").withColumn("beside", beside).drop("yes", "no"))


def by_host(rows: DataFrame, table: DataFrame, keys: list[str], spread: str, how: str) -> DataFrame:
    """``rows`` joined to a table of few rows per host: broadcast up to a checked number and size, else salted."""
    strings = [F.length(c) for c, t in table.dtypes if t == "string"]
    size = table.agg(F.count(F.lit(1)), F.sum(sum(strings[1:], strings[0]))).first()
    if size[0] <= BROADCAST_HOSTS and (size[1] or 0) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(table), keys, how)
    salts = F.explode(F.sequence(F.lit(0), F.lit(HOST_SALTS - 1)))
    return rows.withColumn("salt", F.pmod(F.xxhash64(spread), F.lit(HOST_SALTS)).cast("int")).join(
        table.withColumn("salt", salts), [*keys, "salt"], how
    ).drop("salt")


def under(path: Column) -> Column:
    """The text of a parsed page's blocks under a path, and of those in its parts ``beside``.

    Where the containers at the path leave out text of the page's own best container (``whole``), or
    there is no path, the best container is taken; a page without containers gives all its blocks.
    """
    numbers = F.sequence(F.lit(0), F.size("containers") - 1)
    of = lambda i: F.element_at("containers", i + 1)
    once = lambda value, use: F.element_at(F.transform(F.array(value), use), 1)  # noqa: E731 not again for each element
    at_path = F.filter(numbers, lambda i: of(i)["path"].eqNullSafe(path) & of(i)["whole"])
    best = F.array_max(F.col("containers")["score"])
    own = once(best, lambda b: F.slice(F.filter(numbers, lambda i: of(i)["score"] == b), -1, 1))
    wanted = F.when(F.exists("containers", lambda c: c["path"].eqNullSafe(path) & c["whole"]), at_path).otherwise(own)
    text = lambda blocks: F.array_join(F.transform(blocks, lambda b: b["text"]), "\n")
    return F.when(F.size("containers") == 0, text(F.col("blocks"))).otherwise(
        once(wanted, lambda w: text(F.filter(
            "blocks", lambda b: F.arrays_overlap(b["inside"], w) | F.coalesce(F.array_contains("beside", b["part"]), F.lit(False))
        )))
    )


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: ``id_col, url, text, path`` with the main text and the host's path.

    Character references are decoded, white space inside a block becomes one space, and blocks are
    joined by one line end in page order. Null and empty pages have the empty text; pages without
    address form one host; a page of which the winning path would lose text uses its own best container.
    What lies beside that (a second article, paragraphs before it) is part of the text if it has three words
    and most of it is outside links, unless the host's pages together say otherwise (``judged_parts``): the same text
    beside different articles is none of theirs. Of equal scores the later container is the best.
    Repeated rows count as so many votes for paths. Pages are parsed once and stored as blocks; the
    extraction with the winners reads them. Winners are broadcast up to a checked number and size
    of hosts; beyond, pages join them by host, salted.
    """
    pages = parse_pages(pages, id_col, url_col, html_col).withColumn("page", F.expr("uuid()"))
    parsed, _ = write_table(pages, "parsed-pages")
    winners, _ = write_table(winning_paths(parsed), "host-paths")
    judged, _ = write_table(judged_parts(parsed), "host-parts")
    joined = by_host(keep_parts(parsed, judged), winners, ["host"], "page", "left")
    return joined.select(F.col("row_id").alias(id_col), "url", under(F.col("path")).alias("text"), "path")
