"""HTML extraction and the WARC archive."""

import gzip
import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from tallymart.llm import extract, warc
from tallymart.llm.extract import Page
from tallymart.workspace import scratch_dir

PAGES = "page_id long, url string, html string"


def pages(spark, rows):
    return spark.createDataFrame(rows, PAGES)


def best(html):
    page = Page(html)
    return page.text_in(page.best_path()) or ""


ARTICLE = "<article><h1>Title</h1><p>First paragraph of text.</p><p>Second one.</p></article>"
TEXT = "Title\nFirst paragraph of text.\nSecond one."


@pytest.mark.parametrize("around", [
    "{}", "<nav><a href=x>Menu</a></nav>{}<footer>About us</footer>",
    "<header><h1>Site</h1></header>{}", "<div class='cookie-notice'>We use cookies " + "x" * 900
    + "</div>{}", "<aside>Side</aside>{}<div id=comments><p>" + "Nice! " * 300 + "</p></div>",
    "<form>Mail <input name=a> <button>Go</button></form>{}", "<!-- <p>no</p> -->{}",
    "<script>var a='</p><p>no';</script><style>p{{}}</style>{}", "<div class='ad-slot'>Buy</div>{}",
    "<div role=navigation>x</div>{}", "<div class=\"ads\">a<div>b</div>c</div>{}",
    "<noscript>no</noscript><template><p>no</p></template>{}", "<div hidden>no</div>{}",
    "<div class='sidebar left'><p>" + "side " * 500 + "</p></div>{}"])
def test_boilerplate_goes(around):
    page = "<!DOCTYPE html><html><head><title>T</title></head><body>" + around.format(ARTICLE)
    assert best(page + "</body></html>") == TEXT


@pytest.mark.parametrize("inside, expected", [
    ("<p>a &amp; b &lt;c&gt; &eacute; &#65;&#x42;</p>", "a & b <c> é AB"),
    ("<p>two\n  lines\tand&nbsp;more</p>", "two lines and more"),
    ("<p>one<br>two<br/>three</p>", "one two three"),
    ("<p>open<p>closed by the next<div>block</div>", "open\nclosed by the next\nblock"),
    ("<p><b>bold<br><p>after</p>", "bold\nafter"),
    ("<ul><li>one<li>two <b>b</b></ul>", "one\ntwo b"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
    ("text <i>with</i> inline<blockquote>quote</blockquote>tail", "text with inline\nquote\ntail"),
    ("<p>x</p><div class=share>Share</div><p>y</p>", "x\ny"),
    ("<p>a < b and 1<2</p>", "a < b and 1<2"),
    ("<p title='a > b' class=\"lead\">quoted</p>", "quoted"),
    ("<p>t</p><img alt=no><hr><p>u</p>", "t\nu"),
    ("<P>upper</P><PRE>p  q\nr</PRE>", "upper\np q r"),
    ("<p>cut off <b", "cut off"),
])
def test_blocks(inside, expected):
    assert best(f"<body><article>{inside}</article></body>") == expected


@pytest.mark.parametrize("html", [None, "", "plain", "<", "<p", "<!--", "</div></div>", "<a" * 999,
                                  "<div>" * 3000 + "deep", "&" * 500, "<script>", "<![CDATA[x"])
def test_broken_pages_do_not_fail(html):
    assert isinstance(best(html), str)


def test_hosts_agree_on_a_path(spark):
    """A page whose longest container is not the article follows its host."""
    usual = "<body><div class='story n12'><p>" + "words of the story " * 30 + "</p></div></body>"
    odd = ("<body><div class='story n7'><p>Short story.</p></div><div class='fineprint'><p>"
           + "terms and more terms " * 60 + "</p></div></body>")
    rows = [(i, f"http://a.example/{i}", usual) for i in range(9)] + [
        (9, "https://user@A.example:80/x", odd), (10, "http://b.example/", odd)]
    got = {r["page_id"]: r["text"] for r in extract.extract(pages(spark, rows)).collect()}
    assert got[9] == "Short story."
    assert got[10].startswith("terms and more")


def extracted(spark, rows):
    return {r["page_id"]: r["text"] for r in extract.extract(pages(spark, rows)).collect()}


def paragraphs(word, count=20):
    return "".join(f"<p>{word} {n} and some more words about it.</p>" for n in range(count))


def lines_of(word, count=20):
    return "\n".join(f"{word} {n} and some more words about it." for n in range(count))


@pytest.mark.parametrize("usual, rare", [(9, 1), (6, 4), (4, 6)])
def test_an_article_beside_a_teaser(spark, usual, rare):
    """One template's container is a teaser in the other, which has an article element."""
    rows = [(i, f"http://h/{i}", f"<body><div class=c>{paragraphs('news', 5)}</div></body>")
            for i in range(usual)]
    rows += [(100 + i, f"http://h/l{i}", "<body><div class=c><p>Read on, friends!</p></div><article>"
              + paragraphs("report") + "</article></body>") for i in range(rare)]
    got = extracted(spark, rows)
    assert all(got[i] == lines_of("news", 5) for i in range(usual))
    assert all(got[100 + i] == lines_of("report") for i in range(rare))


@pytest.mark.parametrize("first, second", [(7, 3), (5, 5), (3, 7)])
def test_a_host_of_two_templates(spark, first, second):
    """Both are plain containers, and the path of the first occurs in the second with a few words."""
    rows = [(i, f"http://h/{i}", f"<body><div class=short>{paragraphs('brief', 4)}</div></body>")
            for i in range(first)]
    rows += [(100 + i, f"http://h/l{i}", "<body><div class=short><p>Summary.</p></div>"
              f"<div class='long id{i}'>{paragraphs('essay')}</div></body>") for i in range(second)]
    got = extracted(spark, rows)
    assert all(got[i] == lines_of("brief", 4) for i in range(first))
    assert all(got[100 + i] == lines_of("essay") for i in range(second))


def test_pages_without_a_host_stand_alone(spark):
    """They come from unrelated sites: the many do not decide for the one."""
    rows = [(i, None if i % 2 else "no-host/path",
             f"<body><div class=a>{paragraphs('one', 6)}</div></body>") for i in range(8)]
    rows.append((8, None, "<body><div class=a><p>Teaser of another site.</p></div><div class=b>"
                 + paragraphs("two", 6) + "</div></body>"))
    got = extracted(spark, rows)
    assert got[0] == got[1] == lines_of("one", 6) and got[8] == lines_of("two", 6)
    assert extract.votes(pages(spark, rows)).count() == 0


def test_every_container_votes(spark):
    """The one path that all pages share lies below many others on each of them."""
    names = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    rows = [(i, f"http://h/{i}", "<body>" + "".join(
        f"<div class='{name}{other}'><p>{'words ' * 60}</p></div>" for other in names[:6])
        + "<section><p>" + "shared part " * 5 + "</p></section></body>")
        for i, name in enumerate(names)]
    counted = {r["path"]: r for r in extract.votes(pages(spark, rows)).collect()}
    assert counted["html/body/section" if "html/body/section" in counted else "body/section"][
        "pages"] == len(names)
    assert len(counted) == 6 * len(names) + 2
    kept = extract.winning_paths(extract.votes(pages(spark, rows))).first()["winners"]
    assert {w["path"] for w in kept} == set(counted)
    assert abs(sum(w["score"] for w in kept) - len(names)) < 1e-3


@pytest.mark.parametrize("part, stays", [
    ("<section id='discussion'><h2>Discussion</h2><p>We find.</p></section>", True),
    ("<h2 id='related-work'>Related work</h2>", True),
    ("<h2 id='side-effects'>Side effects</h2>", True), ("<h3 id='comments'>Its comments</h3>", True),
    ("<header class='article-header'><p>Headline</p></header>", True),
    ("<div class='legal'><p>Of the law.</p></div>", True),
    ("<div class='related-work'><p>Others.</p></div>", True),
    ("<div class='related-posts'><p>More</p></div>", False),
    ("<div class='share'>Share</div>", False), ("<div id='comments'><p>Nice!</p></div>", False),
    ("<div class='comment-list'><p>Nice!</p></div>", False),
    ("<div class='post-comments'><p>Nice!</p></div>", False),
    ("<div id='cookie-bar'><p>Cookies</p></div>", False),
    ("<div class='entry-ad'>Buy</div>", False), ("<div class='notice'>Mind</div>", False),
    ("<form class='x'>Mail</form>", False), ("<aside>Side</aside>", False)])
def test_sections_of_an_article(part, stays):
    got = best(f"<body><article><p>Before it.</p>{part}<p>After it.</p></article></body>")
    assert got.startswith("Before it.") and got.endswith("After it.")
    assert (got != "Before it.\nAfter it.") == stays


@pytest.mark.parametrize("part, stays", [
    ("<div class='post-header'><h1>Headline</h1></div>", True),
    ("<h2 id='side-effects'>Side effects</h2>", True),
    ("<section id='related-work'><p>Others.</p></section>", True),
    ("<div class='site-header'>Site</div>", False), ("<div class='main-header'>Site</div>", False),
    ("<div id='header'>Site</div>", False), ("<div id='site-footer'>End</div>", False),
    ("<div class='legal'>Terms</div>", False), ("<div id='reviews'>Nice!</div>", False)])
def test_sections_outside_articles(part, stays):
    got = best(f"<body><div class=story><p>Before it.</p>{part}<p>After it.</p></div></body>")
    assert (got != "Before it.\nAfter it.") == stays


def test_many_hosts_need_no_broadcast(spark, sf_small, monkeypatch):
    df = spark.read.parquet(f"{sf_small}/pages.parquet")
    few = sorted(map(tuple, extract.extract(df).collect()))
    monkeypatch.setattr(extract, "BROADCAST_PATHS", 3)
    assert sorted(map(tuple, extract.extract(df).collect())) == few


def test_extracting_awkward_rows(spark):
    rows = [(1, None, None), (2, None, ""), (None, "not a url", f"<body>{ARTICLE}</body>"),
            (3, "http://h/", f"<body>{ARTICLE}</body>"), (3, "http://h/", f"<body>{ARTICLE}</body>"),
            (4, "http://h/", "<body><nav>only a menu</nav></body>"),
            (5, "http://h/", "<body><article><p>" + "long " * 100_000 + "</p></article></body>")]
    df = pages(spark, rows).withColumn("text", F.lit("x")).withColumn("path", F.lit("y"))
    got = extract.extract(df).collect()
    assert len(got) == len(rows)
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    texts = sorted((str(r["page_id"]), r["text"][:30]) for r in got)
    assert texts == sorted([("1", ""), ("2", ""), ("None", TEXT[:30]), ("3", TEXT[:30]),
                            ("3", TEXT[:30]), ("4", ""), ("5", ("long " * 6)[:30])])
    assert extract.extract(df.limit(0)).count() == 0


def test_whole_table_against_the_pages_own_markup(spark, sf_medium):
    """The test pages hold their text in one article element of h1 and p."""
    import html as h
    import re
    df = spark.read.parquet(f"{sf_medium}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in extract.extract(df).collect()}
    for r in df.collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = [" ".join(h.unescape(re.sub(r"<[^>]*>", " ", b)).split())
                  for b in re.split(r"</?(?:h1|p)>", inner)]
        assert got[r["page_id"]] == "\n".join(b for b in blocks if b)


# --- WARC ----------------------------------------------------------------------------------------


def archive_rows():
    rng = random.Random(4)
    rows = [(i, f"http://h{i % 5}.example/{i}", f"<p>page {i} " + "abcdefgh"[i % 8] * 400 + "</p>")
            for i in range(120)]
    same = "<html>" + "copy " * 100 + "</html>"
    rows += [(i, f"http://copy/{i}", same) for i in rng.sample(range(1000, 2000), 40)]
    rows += [(3000, None, None), (3001, "http://x/\r\nEvil: 1", ""), (3002, "u", "x" * 99),
             (3003, "u", "x" * 99), (3004, "u", "y" * 100), (3005, "u", "y" * 100),
             (3006, "u", "é" * 50), (3007, "u", "é" * 50), (None, "n", same), (None, "n", "z" * 200),
             (3008, "u", "r" * 150), (3008, "u", "r" * 150), (3009, "u", "r\r\n\r\n" * 60_000)]
    return rows


def expected_records(rows):
    first = {}
    for page_id, _, html in rows:
        payload = (html or "").encode()
        if page_id is not None and len(payload) >= 100:
            first[payload] = min(first.get(payload, page_id), page_id)
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        root = first.get(payload)
        revisit = page_id is not None and root is not None and page_id > root
        out.append((page_id, len(payload), hashlib.sha256(payload).hexdigest(),
                    "revisit" if revisit else "response", root if revisit else None))
    return sorted(out, key=str)


def test_round_trip_of_awkward_rows(spark):
    rows = archive_rows()
    df = pages(spark, rows).withColumn("digest", F.lit(1)).withColumn("shard", F.lit("s"))
    got = warc.write_and_verify(spark, df)
    assert sorted([(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"],
                    r["refers_to"]) for r in got.collect()], key=str) == expected_records(rows)
    assert warc.write_and_verify(spark, df.limit(0)).count() == 0


def files_of(folder):
    return {name: open(os.path.join(folder, name), "rb").read()
            for name in sorted(os.listdir(folder)) if name.endswith(".warc.gz")}


def test_files_depend_on_the_table_alone(spark):
    """Other partitions, other order, other session settings: the same bytes."""
    df = pages(spark, archive_rows())
    folders, manifests = [], []
    for number, layout in enumerate((df, df.repartition(5, "url").orderBy(F.rand(3)))):
        folder = scratch_dir(spark, "warc-test/archive")
        manifest = warc.write_archives(layout, folder, shard_bytes=20_000, file_bytes=3_000)
        folders.append(files_of(folder))
        manifests.append(sorted(tuple(r) for r in manifest.collect()))
        assert os.listdir(os.path.join(folder, "_temporary")) == []
    assert folders[0] == folders[1] and manifests[0] == manifests[1]
    assert len(folders[0]) > 10
    for entry in df.sparkSession.createDataFrame(manifests[0], [
            "shard", "number", "file", "records", "bytes", "sha256"]).collect():
        content = folders[0][entry["file"]]
        assert entry["bytes"] == len(content) and entry["sha256"] == hashlib.sha256(
            content).hexdigest()
        assert gzip.decompress(content).count(b"WARC/1.1\r\n") >= entry["records"]


def test_a_damaged_archive_is_noticed(spark):
    """One byte of one payload is changed; every record around it stays readable and intact."""
    folder = scratch_dir(spark, "warc-test/damaged")
    manifest = warc.write_archives(pages(spark, archive_rows()), folder)
    entry = manifest.first()
    path = os.path.join(folder, entry["file"])
    with open(path, "rb") as file:
        records = [data for _, data in warc.members(iter(lambda: file.read(1 << 16), b""))]
    struck = next(n for n, data in enumerate(records) if b"<p>page " in data)
    damaged = records[struck].replace(b"<p>page ", b"<p>Page ", 1)
    with open(path, "wb") as file:
        for n, data in enumerate(records):
            file.write(gzip.compress(damaged if n == struck else data))
    got = warc.read_archives(manifest.where(F.col("file") == entry["file"]), folder).collect()
    assert len(got) == len(records) == entry["records"]
    assert [r["page_id"] for r in got if not r["intact"]] == [
        warc.parse_record(records[struck])["page_id"]]


def test_a_repeated_rename_changes_nothing(spark):
    folder = scratch_dir(spark, "warc-test/again")
    manifest = warc.write_archives(pages(spark, archive_rows()), folder)
    before = files_of(folder)
    assert warc.read_archives(manifest, folder).count() == len(archive_rows())
    assert files_of(folder) == before
