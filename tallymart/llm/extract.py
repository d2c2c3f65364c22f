"""HTML extraction by consensus paths of hosts.

Three steps: every page's containers are scored by the text they hold outside boilerplate; the pages
of a host vote, with these scores, on generalised tag-class paths (element names with their class
words, without positions, ids or numbers); and every page is extracted anew from the containers on
a winning path. A host may have several templates, so all paths with a hundredth of its votes win,
which are a hundred at most. A path is trusted if two pages have it and it is the best one on half of
those that do. A page takes the best-voted trusted path that holds a fair share of what its own best
path holds, so a teaser does not stand in for an article; ``choose`` has the rest of the rule.
The vote is a Spark aggregation with map-side combining, to which every container contributes; a hot
host costs no task more than its partial sums. Pages without a host neither vote nor follow votes.

Boilerplate never counts and is never extracted: menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles and reader comments, told by element name, role or class words.
Ids and words of two meanings are judged more narrowly, above all inside an article.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.common import bound_batches
from tallymart.workspace import scratch_dir, write_and_read

# Elements whose content is no text at all; it ends at their end tag only.
RAW = frozenset("script style noscript template svg math iframe object canvas textarea "
                "title select xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements outside the article by their name.
CHROME = frozenset("nav footer aside form button dialog menu head".split())
# Inside an article, a header is part of it; elsewhere it is the site's.
BLOCKS = frozenset(
    "html body address article blockquote center dd details div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr legend li main nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul aside menu dialog caption hgroup search".split())
CONTAINERS = frozenset("article main section div td body blockquote".split())
# An open p is closed by these; an open element on the left by those on the right.
CLOSES_P = BLOCKS - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"},
    "option": {"option"}, "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"},
}
SCOPES = frozenset("ul ol dl table td th article section div body html main aside nav".split())

# Words of class, id and role attributes that mark boilerplate.
NOISE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner sponsor sponsored "
    "promo promotion promoted nav navbar navigation menu menus breadcrumb breadcrumbs topbar "
    "header masthead footer foot colophon sidebar sidebars side rail aside widget widgets related "
    "recommended recommendations notice notices cookie cookies consent gdpr popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social toolbar pagination pager "
    "comment comments disqus reply replies respond discussion reviews copyright legal disclaimer "
    "contentinfo complementary search searchbox form alert skip hidden".split())
# Words that mean boilerplate in an id too; other ids name sections, such as "related-work".
UNMISTAKABLE = frozenset(
    "ad ads advert adverts advertisement advertising adsense adslot sponsored nav navbar navigation "
    "menu menus breadcrumb breadcrumbs masthead footer sidebar sidebars cookie cookies consent gdpr "
    "popup newsletter comment comments disqus".split())
# Words that inside an article more often name its own parts.
AMBIGUOUS = frozenset("header legal disclaimer copyright discussion reviews side rail form search "
                      "alert foot skip".split())
# Words that are boilerplate inside an article only where they make up the name with FILLER.
LINKING = frozenset("related recommended recommendations".split())
FILLER = frozenset("posts articles links stories box list items section block container".split())
# Class words that win over AMBIGUOUS ones beside them; a header is saved by the first four alone.
MAIN = frozenset("article post entry story content main body text".split())
HEADED = frozenset("article post entry story".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(
    r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?=[\s=/>]|$)"
    r"(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?", re.I)
WORDS = re.compile(r"[a-z]+")

BROADCAST_PATHS = 50_000  # winning paths of all hosts that may be broadcast
SALTS = 64  # parts of a host's pages beyond that
MIN_SCORE = 1.0
MIN_SHARE = 0.01  # of its host's votes, for a path to win
FAIR = 0.6  # of the best path's score; more than the half that a container adds to the one around it
OVERRULE = 3.0  # times the votes of a page's own best path, for an untrusted path to replace it


def _noisy_class(word: str, in_article: bool) -> bool:
    """Whether a class word marks boilerplate."""
    parts = set(WORDS.findall(word))
    marks = parts & NOISE
    if parts & MAIN:
        marks -= AMBIGUOUS if parts & HEADED else AMBIGUOUS - {"header"}
    if in_article:
        marks -= AMBIGUOUS
        if marks and marks <= LINKING:
            return parts <= NOISE | FILLER
    return bool(marks)


def _noisy_id(word: str, in_article: bool) -> bool:
    """Whether an id marks boilerplate: by an unmistakable word, or outside articles as a whole."""
    parts = set(WORDS.findall(word))
    if parts & UNMISTAKABLE:
        return True
    return bool(parts) and parts <= NOISE and not in_article


def _noise(name: str, attributes: str, in_article: bool) -> bool:
    if name in CHROME:
        return True
    if name == "header" and not in_article:
        return True
    if not attributes:
        return False
    for key, *values in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values).lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
        if key == "style":
            if "display:none" in value.replace(" ", ""):
                return True
        elif name in ("html", "body", "article", "main"):
            continue
        elif key == "id":
            if name not in HEADINGS and any(_noisy_id(w, in_article) for w in value.split()):
                return True
        elif key == "role":
            if NOISE.intersection(WORDS.findall(value)):
                return True
        elif any(_noisy_class(w, in_article) for w in value.split()):
            return True
    return False


def _step(name: str, attributes: str) -> str:
    """Generalised element: its name and its class words in order, without numbers."""
    if not attributes:
        return name
    for key, *values in ATTRIBUTE.findall(attributes):
        if key.lower() == "class":
            words = sorted({"".join(WORDS.findall(w)) for w in "".join(values).lower().split()}
                           - {""})
            return ".".join([name, *words])
    return name


class Page:
    """Containers and blocks of one page, outside boilerplate.

    ``containers`` holds [path, parent, text characters, link characters, blocks, headings], the
    counts being those directly in the container and not in a container below it. ``blocks`` holds
    (text, containers it lies in) in page order.
    """

    def __init__(self, source: str | None):
        self.containers: list[list] = []
        self.blocks: list[tuple[str, tuple[int, ...]]] = []
        self._read(source or "")

    def _read(self, source: str) -> None:
        stack: list[tuple[str, str, bool, int]] = []  # name, step, noise, container or -1
        noise = links = articles = 0
        open_containers: list[int] = []
        pending: list[str] = []
        linked = heading = 0

        def flush() -> None:
            nonlocal pending, linked
            text = " ".join(html.unescape("".join(pending)).split())
            if text:
                chain = tuple(open_containers)
                self.blocks.append((text, chain))
                if chain:
                    own = self.containers[chain[-1]]
                    own[2] += len(text)
                    own[3] += min(linked, len(text))
                    own[4] += 1
                    own[5] += heading > 0
            pending, linked = [], 0

        def close(count: int) -> None:
            nonlocal noise, links, articles, heading
            for _ in range(count):
                name, _, is_noise, container = stack.pop()
                if name in BLOCKS:
                    flush()
                noise -= is_noise
                links -= name == "a"
                articles -= name in ("article", "main")
                heading -= name in HEADINGS
                if container >= 0:
                    open_containers.pop()

        at, size = 0, len(source)
        while at < size:
            found = TOKEN.search(source, at)
            end = found.start() if found else size
            if end > at and not noise:
                piece = source[at:end]
                pending.append(piece)
                linked += len(piece) if links else 0
            if not found:
                break
            at = found.end()
            name = found[2]
            if name is None:
                continue
            name = name.lower()
            if found[1]:
                if name == "br":
                    pending.append(" ")
                    continue
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] == name:
                        close(len(stack) - depth)
                        break
                    if name not in BLOCKS and stack[depth][0] in BLOCKS:
                        break  # an inline end tag closes nothing beyond its block
                continue
            attributes = found[3] or ""
            if name in RAW:
                closing = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I).search(source, at)
                at = closing.start() if closing else size
                if closing:
                    after = source.find(">", at)
                    at = size if after < 0 else after + 1
                continue
            if name in VOID:
                if name == "hr":
                    flush()
                elif not noise:
                    pending.append(" " if name in ("br", "wbr") else "")
                continue
            if name in CLOSES_P:
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] == "p":
                        close(len(stack) - depth)
                        break
                    if stack[depth][0] in BLOCKS:
                        break
            closers = [k for k, v in CLOSED_BY.items() if name in v]
            if closers:
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] in closers:
                        close(len(stack) - depth)
                        break
                    if stack[depth][0] in SCOPES and not (
                            stack[depth][0] in ("td", "th") and name in ("tr", "tbody", "tfoot")):
                        break
            if name in BLOCKS:
                flush()
            if name in ("html", "body") and any(s[0] == name for s in stack):
                continue
            is_noise = _noise(name, attributes, articles > 0)
            if attributes.endswith("/") and name not in BLOCKS:
                continue
            step, container = _step(name, attributes), -1
            noise += is_noise
            links += name == "a"
            articles += name in ("article", "main")
            heading += name in HEADINGS
            if name in CONTAINERS and not noise:
                container = len(self.containers)
                path = "/".join([*(s[1] for s in stack if s[0] in BLOCKS), step])
                parent = open_containers[-1] if open_containers else -1
                self.containers.append([path, parent, 0, 0, 0, 0])
                open_containers.append(container)
            stack.append((name, step, bool(is_noise), container))
        close(len(stack))
        flush()

    def scores(self) -> list[float]:
        """Score of every container: its own text outside links, with half of the text below it.

        Text counts in full where it lies and by half one container up, so that the smallest
        container that holds most paragraphs wins over those around it. An article or main element
        gets more than what it loses so to one container in it.
        """
        weight = {"article": 2.5, "main": 2.1}
        own = [max(0.0, text - 2.0 * linked) + 25.0 * (blocks > 1)
               for _, _, text, linked, blocks, _ in self.containers]
        total = list(own)
        for index in range(len(own) - 1, -1, -1):
            parent = self.containers[index][1]
            if parent >= 0:
                total[parent] += total[index] * 0.5
        return [value * weight.get(c[0].rsplit("/", 1)[-1].split(".")[0], 1.0)
                for value, c in zip(total, self.containers)]

    def text_in(self, path: str | None) -> str | None:
        """Text of the containers on a path; None if the page has none."""
        chosen = {i for i, c in enumerate(self.containers) if c[0] == path}
        if not chosen:
            return None
        return "\n".join(text for text, chain in self.blocks if not chosen.isdisjoint(chain))

    def best_path(self) -> str | None:
        scores = self.scores()
        if not scores or max(scores) < MIN_SCORE:
            return None
        return self.containers[scores.index(max(scores))][0]

    def path_scores(self) -> dict[str, float]:
        """Score of every path with some text, summed over its containers."""
        sums: dict[str, float] = {}
        for container, value in zip(self.containers, self.scores()):
            sums[container[0]] = sums.get(container[0], 0.0) + value
        return {path: value for path, value in sums.items() if value >= MIN_SCORE}


def _trusted(pages: int, leads: int) -> bool:
    return pages >= 2 and 2 * leads >= pages


def choose(page: Page, winners: list[tuple[str, int, int, float]]) -> str | None:
    """The path that a page is extracted from; None if it has no text.

    ``winners`` are (path, pages, pages that it is best on, votes) of the host, most votes first.
    Taken is the first of these that the page has:

    1. the best-voted trusted path with a fair share of the score of the page's own best path;
    2. its own best path if that is an article or main element, and its host's pages do not mostly
       have something better than that path;
    3. the best-voted trusted path, however little it holds;
    4. the best-voted path, if it has ``OVERRULE`` times the votes of the page's own best path;
    5. its own best path.
    """
    best = page.best_path()
    if best is None:
        return None
    scores = page.path_scores()
    carried = [w for w in winners if w[0] in scores]
    trusted = [w for w in carried if _trusted(w[1], w[2])]
    for path, *_ in trusted:
        if scores[path] >= FAIR * scores[best]:
            return path
    known = next((w for w in carried if w[0] == best), (best, 0, 0, 0.0))
    distrusted = known[1] >= 2 and not _trusted(known[1], known[2])
    if best.rsplit("/", 1)[-1].split(".")[0] in ("article", "main") and not distrusted:
        return best
    if trusted:
        return trusted[0][0]
    if carried and known[3] > 0 and carried[0][3] >= OVERRULE * known[3]:
        return carried[0][0]
    return best


def host_of(url: Column) -> Column:
    """The host in lower case without user and port; empty for NULL or a URL without one."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":\d*$", ""))


def votes(pages: DataFrame) -> DataFrame:
    """host, path, pages that have it, pages it is best on, and score, summed over pages with a host.

    Every path of a page votes, by its share of the page's scores.
    """

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sums: dict[tuple[str, str], list] = {}
            for host, source in zip(batch["host"], batch["html"]):
                page = Page(source)
                best, scores = page.best_path(), page.path_scores()
                whole = sum(scores.values())
                for path, value in scores.items():
                    entry = sums.setdefault((host, path), [0, 0, 0.0])
                    entry[0] += 1
                    entry[1] += path == best
                    entry[2] += value / whole  # every page has the same say
            yield pd.DataFrame([(*key, *sums[key]) for key in sums],
                               columns=["host", "path", "pages", "leads", "score"])

    located = pages.select(host_of(F.col("url")).alias("host"), "html").where("host <> ''")
    return (located.mapInPandas(
        score, "host string, path string, pages long, leads long, score double")
        .groupBy("host", "path").agg(F.sum("pages").alias("pages"), F.sum("leads").alias("leads"),
                                     F.round(F.sum("score"), 6).alias("score")))


def winning_paths(counted: DataFrame) -> DataFrame:
    """host and ``winners``: its paths with ``MIN_SHARE`` of its votes.

    They are in falling order of votes; ties go to more pages, then the smaller path.
    """
    shares = counted.groupBy("host").agg(F.sum("score").alias("whole"))
    entry = F.struct("path", "pages", "leads", "score")
    ranked = F.array_sort(F.collect_list(F.struct(
        (-F.col("score")).alias("votes"), (-F.col("pages")).alias("spread"), "path",
        entry.alias("entry"))))
    return (counted.join(shares, "host").where(F.col("score") >= F.col("whole") * MIN_SHARE)
            .groupBy("host").agg(F.transform(ranked, lambda w: w["entry"]).alias("winners")))


def with_winners(located: DataFrame, winners: DataFrame) -> DataFrame:
    """Rows of ``located`` with the winners of their host, if it has any.

    A table of few hosts is broadcast and no page is moved. Otherwise both sides are shuffled by
    host and salt: each host's one row is repeated for every salt, its pages are dealt over them.
    """
    paths = winners.agg(F.coalesce(F.sum(F.size("winners")), F.lit(0))).first()[0]
    if paths <= BROADCAST_PATHS:
        return located.join(F.broadcast(winners), "host", "left")
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")
    repeated = winners.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return located.withColumn("salt", salt).join(repeated, ["host", "salt"], "left").drop("salt")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars and path of every page.

    ``path`` is the container path that the text comes from. Defined cases: NULL and empty html give
    an empty text; pages with a NULL url, or one without a host, use their own best path; pages
    without any text outside boilerplate give an empty text; repeated rows give equal rows, each with
    a vote; an empty table gives an empty result; further columns are ignored.
    """
    spark = pages.sparkSession
    bound_batches(spark)
    counted = write_and_read(votes(pages), scratch_dir(spark, "extract/votes"))
    winners = write_and_read(winning_paths(counted), scratch_dir(spark, "extract/winners"))
    slim = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    located = with_winners(slim, winners).select(
        "page_id", "url", "html",
        F.to_json(F.transform("winners", lambda w: F.array(
            w["path"], w["pages"].cast("string"), w["leads"].cast("string"),
            w["score"].cast("string")))).alias("winners"))

    @F.pandas_udf("text string, path string")
    def main_text(sources: pd.Series, winners: pd.Series) -> pd.DataFrame:
        rows, hosts = [], {None: []}
        for source, packed in zip(sources, winners):
            if packed not in hosts:
                hosts[packed] = [(path, int(pages), int(leads), float(score))
                                 for path, pages, leads, score in json.loads(packed)]
            page = Page(source)
            path = choose(page, hosts[packed])
            rows.append((page.text_in(path) or "" if path else "", path))
        return pd.DataFrame(rows, columns=["text", "path"])

    found = located.withColumn("found", main_text("html", "winners"))
    return found.select(
        "page_id", "url", F.col("found.text").alias("text"),
        F.length("found.text").cast("long").alias("n_chars"), F.col("found.path").alias("path"))
