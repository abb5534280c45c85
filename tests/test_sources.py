"""Article bodies against a parser of their own kind, and sources of which some fail."""

import os
import random
import re
import time
from html.parser import HTMLParser

import duckdb
import oracle
import pytest
from pyspark.sql import functions as F

from dayline import lexicon, schemas
from dayline.functions import markup
from dayline.plans import source_plans
from dayline.sources import articles, collect, payloads, tables


class Blocks(HTMLParser):
    """Blocks of a page by a parser that calls back, to hold the expressions against."""

    def __init__(self):
        super().__init__()
        self.skipped, self.path, self.tag, self.parts, self.out = 0, [], "", [], []

    def finish(self):
        text = re.sub(r"\s+([.,;:!?])", r"\1", " ".join(" ".join(self.parts).split())) if self.tag else ""
        if text:
            self.out.append((any(holds for _, holds in self.path), text))
        self.tag, self.parts = "", []

    def handle_starttag(self, tag, attrs):
        if tag in lexicon.SKIP_TAGS:
            self.skipped += 1
        elif not self.skipped:
            named = [(v or "").lower() for k, v in attrs if k in lexicon.CONTAINER_ATTRIBUTES]
            self.path.append((tag, tag in lexicon.CONTAINER_TAGS or any(h in v for v in named for h in lexicon.CONTAINER_HINTS)))
            if tag in lexicon.BLOCK_TAGS:
                self.tag, self.parts = tag, []

    def handle_endtag(self, tag):
        if tag in lexicon.SKIP_TAGS:
            self.skipped = max(0, self.skipped - 1)
        elif not self.skipped:
            if tag == self.tag:
                self.finish()
            last = max((i for i, (name, _) in enumerate(self.path) if name == tag), default=None)
            if last is not None:
                del self.path[last:]

    def handle_data(self, data):
        if self.tag and not self.skipped:
            self.parts.append(data)


def parsed(html):
    reader = Blocks()
    reader.feed((html or "").strip())
    reader.close()
    reader.finish()
    return reader.out


def random_page(rng):
    tags = ["p", "li", "h1", "div", "span", "nav", "article", "b", "br", "script", "pre", "blockquote", "footer", "main", "form"]
    attributes = ["", " class='x'", ' id="main-col"', ' data-x=" id=story"', " CLASS=post", " hidden", ' title="a > b"']
    texts = ["some words here.", "a & b", "x &amp; y &#8212; z", "1 < 2", "ü ", "&copy; now", "&#x41;&#0;", " . ", "\n", "<!-- c <p>x</p> -->"]
    out = []
    for _ in range(rng.randint(1, 40)):
        kind, tag = rng.random(), rng.choice(tags)
        if kind < 0.4:
            out.append(f"<{tag}{rng.choice(attributes)}{rng.choice(['>', '>', '>', '/>'])}")
        else:
            out.append(f"</{tag}>" if kind < 0.7 else rng.choice(texts))
    return "".join(out)


def test_blocks_are_those_of_a_parser(spark):
    rng = random.Random(1)
    pages = [None, "", " ", "plain", "<p>cut <b class=", "<p>a<p>b</p>", "<p>x</p", "<p/>", "</p></p>"]
    pages += [random_page(rng) for _ in range(600)]
    rows = spark.createDataFrame([(i, p, "x") for i, p in enumerate(pages)], "i int, h string, error string")
    got = {r["i"]: r for r in markup.with_blocks(rows.drop("error"), "h").collect()}
    for i, page in enumerate(pages):
        assert [(b["in_container"], b["block"]) for b in got[i]["blocks"]] == parsed(page), page
        assert [b["pos"] for b in got[i]["blocks"]] == list(range(len(got[i]["blocks"])))
    assert [got[i]["error"] for i in range(5)] == ["no_page", "no_page", "no_page", "no_markup", None]


def test_a_page_of_many_blocks(spark):
    page = "<div>" + "<p>word word word word word.</p><b>x</b>" * 20_000 + "<p>" * 3000 + "</div>"
    begun = time.time()
    assert spark.createDataFrame([(page,)], "h string").transform(markup.with_blocks, "h").select(F.size("blocks")).first()[0] == 20_000
    assert time.time() - begun < 60


def test_articles_with_errors_have_no_text(spark):
    useful = "<p>one two three four five six seven.</p>"
    rows = [(0, None), (1, "just text"), (2, "<div>x</div>"), (3, "<p>short</p>"), (4, f"<main>{useful}{useful}</main><p>six words that stand outside it.</p>")]
    got = {r["page_id"]: r for r in articles.article_text(spark.createDataFrame(rows, "page_id int, html string")).collect()}
    assert [got[i]["article_error"] for i in range(5)] == ["no_page", "no_markup", "no_blocks", None, None]
    assert [got[i]["article_text"] for i in range(4)] == [None, None, None, ""]
    assert got[4]["block_count"] == 3 and "outside" in got[4]["article_text"]  # too little in the container


# --- sources
RSS = "<rss><channel>{}</channel></rss>"
ITEM = "<item><title>Title {0}</title><link>https://a.com/{0}</link><pubDate>Wed, 20 May 2026 1{0}:00:00 GMT</pubDate><description>about {0}</description></item>"


def landed(spark, *rows):
    """Payloads of ``(source, status, body)``, the body's entries in the order of landing."""
    full = [(s, f"https://f.com/{s}/{i}", "2026-05-21 00:00:00", status, "text/xml", body) for i, (s, status, body) in enumerate(rows)]
    names = [f.split()[0] for f in schemas.PAYLOAD.split(", ")]
    return spark.createDataFrame(full, ", ".join(f"{n} {'int' if n == 'status' else 'string'}" for n in names)).withColumn("fetched_at", F.to_timestamp("fetched_at"))


def configured(spark, *rows):
    return spark.createDataFrame([(*r, *[None] * (6 - len(r))) for r in rows], collect.SETTINGS)


def as_of():
    return F.lit("2026-05-21 00:00:00").cast("timestamp")


def test_a_failed_source_stops_no_other(spark):
    good = RSS.format("".join(ITEM.format(i) for i in range(3)))
    pages = landed(
        spark, ("ok", 200, good), ("mixed", 200, good), ("mixed", 500, "oops"), ("broken", 200, good[:90]), ("limited", 429, ""),
        ("blank", 200, "  "), ("none", 200, RSS.format("")), ("off", 200, good), ("repo", 403, "{}"), ("list", 200, '{"message": "no"}'), ("stranger", 200, good),
    )
    rules = configured(
        spark, *[(s, "feed", True) for s in ("ok", "mixed", "broken", "limited", "blank", "none", "unseen")], ("off", "feed", False),
        ("repo", "releases", None), ("list", "releases", True),
    )
    found = collect.collect(pages, rules, as_of())
    errors = {(r["source_name"], r["failure"], r["detail"]) for r in collect.errors(found).collect()}
    assert errors == {
        ("mixed", "http_error", "status 500"), ("broken", "invalid_payload", good[:80]), ("limited", "rate_limited", "status 429"),
        ("blank", "empty_body", ""), ("repo", "http_error", "status 403"), ("list", "invalid_payload", '{"message": "no"}'),
    }
    status = {r["source_name"]: (r["status"], r["items"], r["attempts"], r["failures"]) for r in collect.source_status(found, pages, rules).collect()}
    assert status == {
        "ok": ("succeeded", 3, 1, 0), "mixed": ("partial", 3, 2, 1), "broken": ("failed", 0, 1, 1), "limited": ("rate_limited", 0, 1, 1),
        "blank": ("failed", 0, 1, 1), "none": ("empty", 0, 1, 0), "unseen": ("empty", 0, 0, 0), "repo": ("rate_limited", 0, 1, 1), "list": ("empty", 0, 1, 1),
    }
    assert {r["source"] for r in collect.items(found).collect()} == {"ok", "mixed"}


def test_window_keywords_and_cap_per_source(spark):
    good = RSS.format("".join(ITEM.format(i) for i in range(5)))
    pages = landed(spark, ("a", 200, good), ("a", 200, good.replace("a.com", "b.com")), ("b", 200, good), ("c", 200, good), ("d", 200, good))
    rules = configured(spark, ("a", "feed", True, 7), ("b", "feed", True, None, 0), ("c", "feed", True, 9, None, ["title 3", " "]), ("d", "feed", True, 2, 1, ["ABOUT"]))
    urls = {}
    for r in collect.items(collect.collect(pages, rules, as_of())).collect():
        urls.setdefault(r["source_name"], []).append(r["url"][8:])
    assert {k: sorted(v) for k, v in urls.items()} == {
        "a": sorted([f"a.com/{i}" for i in range(5)] + ["b.com/0", "b.com/1"]), "c": ["a.com/3"], "d": ["a.com/0", "a.com/1"],
    }


def test_a_write_of_nothing_fails_and_readers_keep_what_was(spark, tmp_path):
    rules = configured(spark, ("a", "feed", True), ("b", "feed", True))
    good = RSS.format(ITEM.format(1))
    collect.write_collected(collect.collect(landed(spark, ("a", 200, good), ("b", 500, "")), rules, as_of()), str(tmp_path), "1")
    with pytest.raises(collect.NothingCollected, match="a: empty_body; b: http_error status 500"):
        collect.write_collected(collect.collect(landed(spark, ("a", 200, ""), ("b", 500, "")), rules, as_of()), str(tmp_path), "2")
    kept = tables.published(spark, str(tmp_path))
    assert collect.items(kept).count() == 1 and collect.errors(kept).count() == 1
    with pytest.raises(ValueError, match="no enabled sources"):
        collect.collect(landed(spark, ("a", 200, good)), configured(spark, ("a", "feed", False)), as_of())


def test_payload_files_have_the_columns_of_payloads(spark, tmp_path):
    landed(spark, ("a", 200, "x")).write.parquet(f"{tmp_path}/p")
    assert payloads.read_payloads(spark, f"{tmp_path}/p").first()["body"] == "x"


def test_publishes_have_rising_numbers_and_old_ones_can_be_read(spark, tmp_path):
    rows = lambda n: spark.range(n)
    target = str(tmp_path / "t")
    with pytest.raises(ValueError, match="nothing was published"):
        tables.published(spark, target)
    assert [tables.publish(rows(n), target, f"v{n}") for n in (1, 2, 3)] == [1, 2, 3]
    os.close(os.open(f"{target}/pointer/{4:012d}", os.O_CREAT))  # of a publish that died before it wrote its version
    assert tables.published(spark, target).count() == 3 and tables.published(spark, target, 2).count() == 2
    assert tables.publish(rows(9), target, "v9") == 5 and tables.published(spark, target).count() == 9


# --- queries over documents without a text
GIVEN = "/root/testdata/sf0.001"
BLANK_TEXTS = ["set1_source_union", "src12_item_ids", "src2_atom_feeds", "src2_rss_feeds", "src4_papers", "src5_releases", "src2_capped", "src7_union", "src7_failures", "ag16_adapter_counts"]


def given_with(folder, text):
    """The given tables with another text in ``documents``."""
    for name in oracle.TABLES:
        if name != "documents":
            os.symlink(f"{GIVEN}/{name}.parquet", f"{folder}/{name}.parquet")
    duckdb.sql(f"COPY (SELECT * REPLACE ({text} AS text) FROM '{GIVEN}/documents.parquet') TO '{folder}/documents.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.fixture(scope="module")
def blank_texts(tmp_path_factory):
    """Three of eight documents with an empty, a missing or a blank text."""
    return given_with(tmp_path_factory.mktemp("blank"), "CASE doc_id // 3 % 8 WHEN 0 THEN '' WHEN 3 THEN NULL WHEN 6 THEN ' ' || chr(10) || ' ' ELSE text END")


@pytest.fixture(scope="module")
def control_characters(tmp_path_factory):
    """Some documents with characters that XML 1.0 has not, in the title and behind it, among them what looks like a reference."""
    return given_with(tmp_path_factory.mktemp("control"), "CASE doc_id % 9 WHEN 4 THEN 'a' || chr(1) || chr(27) || '&#7; b]]>. c' || chr(12) || 'd' || chr(159) || text WHEN 5 THEN 'x' || chr(2) || 'y ' || text ELSE text END")


@pytest.mark.parametrize("name", ["set1_source_union", "src2_atom_feeds", "src2_rss_feeds", "src4_papers"])
def test_control_characters_lose_no_payload(spark, control_characters, name):
    rows, message, _ = oracle.compare(spark, oracle.connect(control_characters), control_characters, *source_plans.PLANS[name])
    assert message is None and rows > 0


@pytest.mark.parametrize("name", BLANK_TEXTS)
def test_documents_without_a_text_are_in_the_result(spark, blank_texts, name):
    rows, message, _ = oracle.compare(spark, oracle.connect(blank_texts), blank_texts, *source_plans.PLANS[name])
    assert message is None and rows > 0


def test_untitled_entries_stay_if_asked_for(spark):
    feed = landed(spark, ("a", 200, RSS.format(ITEM.format(1) + ITEM.format(2).replace("Title 2", " ") + ITEM.format(3))))
    assert [r["pos"] for r in payloads.rss_entries(feed).orderBy("pos").collect()] == [0, 2]
    assert [(r["pos"], r["title"]) for r in payloads.rss_entries(feed, untitled=True).orderBy("pos").collect()] == [(0, "Title 1"), (1, ""), (2, "Title 3")]


def test_releases_without_a_name_stay_if_asked_for(spark):
    pages = landed(spark, ("r", 200, '[{"id": 1, "name": "One", "html_url": "https://a.com/1"}, {"id": 2, "name": " ", "html_url": "https://a.com/2"}, {"id": 3, "name": "None"}]'))
    assert [r["title"] for r in payloads.release_entries(pages).collect()] == ["r One"]
    assert [r["title"] for r in payloads.release_rows(pages, untitled=True).orderBy("pos").collect()] == ["r One", "r"]
