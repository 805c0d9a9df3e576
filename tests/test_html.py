import json

from hirelens.functions import html as H
from hirelens.plans import load
from hirelens.sources import pages as P
from hirelens.streaming.incremental import load_stream

LD = {"title": "Research Software Engineer", "hiringOrganization": {"name": "Uni", "department": {"name": "Physics"}}, "baseSalary": {"value": "£30,000"}, "datePosted": "2020-03-02", "validThrough": "2020-03-30", "description": "<p>Write <b>code</b></p>", "employmentType": "Full Time,Permanent", "jobLocation": [{"address": {"addressLocality": "Leeds", "addressRegion": "Yorkshire"}}]}
JSON_PAGE = f'<html><head><script type="application/ld+json">{json.dumps(LD)}</script></head><body><b>Subject Area(s):</b><input name="categoryId[]"><input value="IT"><input name="categoryId[]"><input value="Maths"><input class="j-form-input__location" value="London"></body></html>'
LONG = "A long description of the work. " * 10
NORMAL = f'<body><h1>Lecturer</h1><h3>College</h3><table><tr><td class="detail-heading">Salary:</td><td>£40,000 to £45,000</td></tr><tr><td class="detail-heading">Placed on:</td><td>3rd April 2020</td></tr><tr><td class="detail-heading">Contract Type:</td><td>Permanent</td></tr></table><div class="section">short</div><div class="section">{LONG}</div><div class="inlineBox"><p>Type / Role:</p><p><a>Academic</a><a>PhD</a></p></div></body>'


def test_json_page(spark):
    r = H.parse_adverts(spark.createDataFrame([("j1", JSON_PAGE)], "jobid string, html string"), "2020-04-01").first()
    assert (r.job_title, r.employer, r.department, r.location, r.region) == ("Research Software Engineer", "Uni", "Physics", "Leeds", "Yorkshire")
    assert (r.salary_min, r.hours, r.contract, r.description, r.enhanced) == (30000.0, ["Full Time"], "Permanent", "Write code", "json")
    assert (r.subject_area, r.extra_location, str(r.date)[:10], r.duration_ad_days) == (["IT", "Maths"], "London", "2020-03-02", 28)


def test_normal_page(spark):
    r = H.parse_adverts(spark.createDataFrame([("n1", NORMAL)], "jobid string, html string"), "2020-05-01").first()
    assert (r.job_title, r.employer, r.location, r.description) == ("Lecturer", "College", "College", LONG.strip())
    assert (r.salary_min, r.salary_max, r.contract, str(r.placed_on)[:10], r.enhanced) == (40000.0, 45000.0, "Permanent", "2020-04-03", "normal")
    assert r.type_role == ["Academic", "PhD"]
    far = H.parse_adverts(spark.createDataFrame([("n1", NORMAL)], "jobid string, html string"), "2018-05-01").first()
    assert far.date is None


def test_detail_layouts():
    th = '<table><tr><th class="j-advert-details__table-header">Hours:</th><td>Full</td></tr></table>'
    assert H.Page(th).details() == {"hours": "Full"}
    assert H.Page("<dl><dt>Closes:<dd>Monday<dt>Hours<dd>Part</dl>").details() == {"closes": "Monday", "hours": "Part"}
    assert H.Page("<strong>Salary:</strong> £1 <strong>" + "x" * 40 + ":</strong>y").details() == {"salary": " £1 "}
    assert H.Page("").details() == {}


def test_descriptions():
    d = lambda html, e=False: H.Page(html).description(e)
    assert d('<div id="enhanced-content"><div class="section">one<br>two</div></div>', True) == "one two"
    assert d('<div id="enhanced-right">r</div>', True) == "r"
    assert d('<div id="enhanced-content">c</div>', True) == "c"
    assert d('<div id="job-description">jd</div>') == "jd"
    assert d('<div id="rightcol">rc</div>') == "rc"
    assert d('<div class="col-lg-12"><h2>t</h2><p>a</p><ul><li>b</li></ul></div>') == "a b b"
    assert d(f'<div class="jobPost"><p>1<p>2<p>{LONG}<p>4</div>').startswith(LONG.strip())
    assert d(f"<p>{LONG}</p><p>{LONG}@</p><p>no</p>") == LONG


def test_listing_and_urls(spark):
    listing = '<div class="j-search-result__text"><a href="/job/ABC123/engineer">x</a></div><div class="j-search-result__text"><a href="/bad">y</a></div>'
    df = spark.createDataFrame([(listing,)], "html string")
    assert [tuple(r) for r in P.listed_jobs(df, "https://x.test/").collect()] == [("ABC123", "engineer", "https://x.test/job/ABC123/engineer")]


def test_nested_paths(spark):
    record = json.dumps({"json": {"datePosted": "d", "hiringOrganization": {"department": {"name": "n"}}, "jobLocation": {"address": {"addressRegion": "r"}}}, "base": True})
    df = spark.createDataFrame([(record,)], "v string")
    paths = {"base": "true", "json.datePosted": "d", "json.hiringOrganization.department.name": "n", "json.jobLocation.address.addressRegion": "r", "json.absent": None, "json.datePosted.deeper": None}
    for path, value in paths.items():
        assert df.select(H.json_path("v", path)).first()[0] == value


def test_earliest_date(spark):
    df = spark.createDataFrame([("from 3rd May 2019 to 2018-02-01, not 1999-01-01",), ("none",)], "v string")
    assert [str(r[0])[:10] for r in df.select(H.earliest_date("v")).collect()] == ["2018-02-01", "None"]


def test_load_batch_and_stream(spark, tmp_path):
    folder = tmp_path / "pages"
    folder.mkdir()
    (folder / "AAA111").write_text(NORMAL)
    (folder / "BBB222").write_text(JSON_PAGE)
    table = str(tmp_path / "jobs")
    read = P.read_pages(spark, str(folder))
    assert sorted(r.jobid for r in read.collect()) == ["AAA111", "BBB222"]
    assert load.load(read, None, table, "2020-05-01") == {"inserted": 2, "duplicate": 0}
    (folder / "CCC333").write_text("<p>empty</p>")
    stored = spark.createDataFrame(spark.read.parquet(table).select("jobid").collect(), "jobid string")
    assert {r.missing for r in load.dry_run(P.read_pages(spark, str(folder)).where("jobid = 'CCC333'"), "2020-05-01").collect()} >= {"job_title", "date"}
    assert load.load(P.read_pages(spark, str(folder)), stored, str(tmp_path / "more"), "2020-05-01") == {"inserted": 1, "duplicate": 2}
    for _ in range(2):
        q = load_stream(spark, str(folder), str(tmp_path / "streamed"), str(tmp_path / "ck"), "2020-05-01")
        q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "streamed")).count() == 3
    web = P.read_web(spark, [f"file://{folder}/AAA111"]).collect()
    assert web[0].html == NORMAL
