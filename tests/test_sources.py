"""Sources and collection rules: CSV quirks, JSON payloads, HTML parsing, caps."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from murmur.sources import crawl as CR
from murmur.sources import files as FI
from murmur.sources import web as WB


def test_csv_bom_newline_quotes_and_per_file_dedupe(spark):
    d = tempfile.mkdtemp(prefix="murmur-csv-")
    a = os.path.join(d, "comments_0204_0206.csv")
    b = os.path.join(d, "x_20250519~20250521.csv")
    with open(a, "w", encoding="utf-8-sig") as f:
        f.write('comment_text,other\n"line one\nline two",1\n"say ""hi""",2\n"say ""hi""",3\n" pad ",4\n"pad",5\n,6\n"  ",7\n')
    with open(b, "w", encoding="utf-8") as f:
        f.write('comment_text\n"say ""hi"""\nNA\n')
    out = FI.scan_comments(spark, [a, b, os.path.join(d, "missing.csv")])
    rows = sorted((r.time_label, r.text) for r in out.collect())
    assert rows == sorted([
        ("0204_0206", "line one\nline two"), ("0204_0206", 'say "hi"'),
        ("0204_0206", "pad"), ("0204_0206", "pad"),          # duplicates after strip are kept
        ("0519_0521", 'say "hi"'),                            # duplicates across files are kept
    ])


def test_existing_inputs_and_topic_file_scan(spark, tmp_path):
    (tmp_path / "topic_assignments_0101_0102_lda.csv").write_text("x\n")
    (tmp_path / "topic_assignments_0103_0104_lda.csv").write_text("x\n")
    got = FI.topic_file_scan(spark, "lda", str(tmp_path))
    assert [os.path.basename(p) for p in got] == ["topic_assignments_0101_0102_lda.csv",
                                                  "topic_assignments_0103_0104_lda.csv"]
    assert FI.existing_inputs(spark, [str(tmp_path / "nope.csv")] + got) == got
    uri = f"file://{tmp_path}"
    assert len(FI.existing_inputs(spark, [f"{uri}/topic_*_lda.csv", f"{uri}/nope.csv"])) == 2


def test_payload_comments_modtime_presence(spark):
    p1 = ('jQuery123({"result": {"commentList": [{"maskedUserId": "u1", "modTime": "2025-05-19T10:00:00",'
          ' "createTime": "2025-05-19T09:00:00", "contents": "a &amp; b"}, {"maskedUserId": "u2", "modTime": null,'
          ' "createTime": "2025-05-19T08:00:00", "contents": "x"}, {"maskedUserId": "u3",'
          ' "createTime": "2025-05-19T07:00:00", "contents": "&lt;3"}], "totalCommentCount": 3}});')
    df = spark.createDataFrame([("http://n/article/001/0002?x=1", p1)], "url string, payload string")
    rows = sorted((r.comment_author_id, r.comment_published, r.comment_text)
                  for r in WB.payload_comments(df).collect())
    assert rows == [("u1", "2025-05-19T10:00:00", "a & b"), ("u2", None, "x"), ("u3", "2025-05-19T07:00:00", "<3")]


def test_thread_comments_defaults_and_video_join(spark):
    body = ('{"items": [{"snippet": {"topLevelComment": {"snippet": {"authorChannelId": {"value": "c1"},'
            ' "textDisplay": "hi", "publishedAt": "2022-03-01T00:00:00Z", "likeCount": 4}}}},'
            ' {"snippet": {"topLevelComment": {"snippet": {"textDisplay": "yo", "publishedAt": "2022-03-02T00:00:00Z"}}}}]}')
    threads = spark.createDataFrame([("v1", body)], "video_id string, body string")
    videos = spark.createDataFrame([("v1", "chan", "25")], "video_id string, channel string, video_category_id string")
    rows = sorted(WB.thread_comments(threads, videos).collect(), key=lambda r: r.comment_text)
    assert [(r.comment_author_id, r.comment_likes, r.channel) for r in rows] == [("c1", 4, "chan"), (None, 0, "chan")]
    assert CR.category_filter(videos).count() == 1


def test_page_title_fallbacks_and_links(spark):
    html1 = ('<html><h2 class="x">Second &amp; title</h2><div class="news_title">third</div>'
             '<span class="date">2025.05.19.</span><a href="https://n.news.naver.com/article/1/2">a</a>'
             '<a href="https://n.news.naver.com/article/1/2">dup</a><a href="/other">o</a></html>')
    html2 = '<html><div class="end_tit"> Only title </div></html>'
    pages = spark.createDataFrame([(1, "u1", html1), (2, "u2", html2)], "page_id long, url string, html string")
    t = {r.page_id: (r.title, r.date) for r in WB.page_title(pages, keep_incomplete=True).collect()}
    assert t == {1: ("Second & title", "2025.05.19."), 2: ("Only title", None)}
    assert [r.page_id for r in WB.page_title(pages).collect()] == [1]        # both required
    hard = ('<div class="update">not this</div><div class="big news_title">a<div>b</div>c &copy;&amp;lt;</div><div>d</div>'
            '<span class="update">no</span><div class="date">2025</div>')
    got = WB.page_title(spark.createDataFrame([(3, "u", hard)], "page_id long, url string, html string")).first()
    assert (got.title, got.date) == ("abc \u00a9&lt;", "2025")              # whole class tokens, nested elements, rare entities
    assert WB.page_title(pages.limit(0)).collect() == []
    links = WB.page_links(pages).collect()
    assert [(r.page_id, r.link) for r in links] == [(1, "https://n.news.naver.com/article/1/2")]
    oid, aid = WB.url_ids(F.lit("https://n.news.naver.com/article/023/0003912?sid=100"))
    r = spark.range(1).select(oid.alias("o"), aid.alias("a")).first()
    assert (r.o, r.a) == ("023", "0003912")


def test_crawl_manifest_size(spark):
    days = CR.day_range(spark, "2025-05-19", "2025-05-21")
    m = CR.crawl_manifest(days, ["a", "b"])
    assert m.count() == 3 * 2 * 200
    assert m.agg(F.max("page_start")).first()[0] == 1991
    assert CR.day_range(spark, "2022-03-01", "2022-03-09", inclusive=False).count() == 8


def test_empty_run_cutoff(spark):
    # pages 1..: links 3,0,0,2,0,0,0,0,0,5  -> stop at the 5th consecutive empty (page 9); 10 never read
    vals = [3, 0, 0, 2, 0, 0, 0, 0, 0, 5]
    rows = [("d", "k", i + 1, v) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "day string, keyword string, page_start int, n_links int")
    got = [r.page_start for r in CR.empty_run_cutoff(df).orderBy("page_start").collect()]
    assert got == [1, 4]


def test_per_keyword_cap_first_seen_distinct(spark):
    rows = [("d", "k", "u1", 1), ("d", "k", "u1", 2), ("d", "k", "u2", 3), ("d", "k", "u3", 4), ("d", "j", "u1", 5)]
    df = spark.createDataFrame(rows, "day string, keyword string, url string, seq int")
    got = sorted((r.keyword, r.url, r.seq) for r in CR.per_keyword_cap(df, 2).collect())
    assert got == [("j", "u1", 5), ("k", "u1", 1), ("k", "u2", 3)]


def test_stable_id_of_a_wide_table_survives_writing(spark, tmp_path):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "source", "text", "lang")
    FI.stable_id(d, ["source", "doc_id"], "sid").write.parquet(str(tmp_path / "ids"))
    got = spark.read.parquet(str(tmp_path / "ids")).select("sid", "doc_id", "source").orderBy("sid").collect()
    assert [r.sid for r in got] == list(range(10_000))
    assert [(r.source, r.doc_id) for r in got] == sorted((r.source, r.doc_id) for r in got)


def test_stable_id_is_dense_and_ordered(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 7 % 1000).alias("k"))
    got = FI.stable_id(df, ["k"], "sid").orderBy("k").collect()
    assert [r.sid for r in got] == list(range(1000))


def test_union_frames_empty_is_typed(spark):
    e = FI.union_frames(spark, [], "a long, b string")
    assert e.count() == 0 and e.columns == ["a", "b"]


def test_write_assignments_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1, "0101_0101", "lda"), (2, "0102_0102", "lda")],
                               "comment_id long, time_label string, topic_method string")
    FI.write_assignments(df, str(tmp_path / "out"))
    assert sorted(os.listdir(tmp_path / "out" / "topic_method=lda")) == ["time_label=0101_0101",
                                                                          "time_label=0102_0102"]
    arts = spark.createDataFrame([("k", "t", dt.date(2025, 5, 19), "u")], "keyword string, title string, date date, url string")
    FI.append_articles(arts, str(tmp_path / "arts"))
    FI.append_articles(arts, str(tmp_path / "arts"))
    back = spark.read.parquet(str(tmp_path / "arts"))
    assert back.columns == ["Keyword", "Title", "Date", "URL"] and back.count() == 2


def test_channel_counts_zeros_included(spark):
    comments = spark.createDataFrame([(1, "a"), (2, "a"), (3, "c")], "comment_id long, channel string")
    channels = spark.createDataFrame([("a",), ("b",), ("c",), ("b",)], "channel string")
    got = sorted(tuple(r) for r in CR.channel_counts(comments, channels).collect())
    assert got == [("a", 2), ("b", 0), ("c", 1)]
