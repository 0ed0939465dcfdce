from pyspark.sql import functions as F

from offerlens.plans import directory_ingest as di


def test_three_sites_in_one_run(spark):
    rules = di.known_rules(spark)
    host = {r.source: r.host for r in rules.collect()}
    card = '<li class="x item y"><h3 class="small_title"> <b>{}</b>  SL</h3><a href="/about">a</a><a href="{}">b</a></li>'.format
    case = '<li class="element-list"><h3>{}</h3><a href="{}">b</a></li>'.format
    slide = '<article class="startup-slide"><a href="{1}"><h3>{0}</h3></a></article>'.format
    listing = spark.createDataFrame([
        ("catalonia", 0, f"https://{host['catalonia']}/list", card("Acme", "/startup/bcn/acme/12/?x=1") + '<li class="item"><h3> </h3><a href="/startup/bcn/none/13">b</a></li>' + card("Bad", "/startup/bcn/bad/x")),
        ("catalonia", 1, f"https://{host['catalonia']}/list?p=2", card("Again", "/startup/bcn/acme/12") + card("Twin", "/startup/bcn/twin/14") + card("Elsewhere", "https://o.es/startup/a/b/1")),
        ("madrimasd", 0, f"https://{host['madrimasd']}/emprendedores/list", case("Bee", "emprendedores-casos-exito/bee") + case("Gone", "/emprendedores/emprendedores-casos-exito/gone#x")),
        ("lanzadera", 0, f"https://{host['lanzadera']}/", slide("Cee", "/proyecto/cee") + slide("Deep", "/proyecto/cee/deep") + '<article class="startup-slide"><a href="/proyecto/d">no title</a></article>'),
    ], "source string, page_no int, url string, html string")
    site = '<a href="https://linkedin.com/x">in</a><a href="{}">web</a>'.format
    pages = spark.createDataFrame([
        (f"https://{host['catalonia']}/startup/bcn/acme/12", site("https://www.acme.com/")), (f"https://{host['catalonia']}/startup/bcn/twin/14", site("https://acme.com/es")),
        (f"https://{host['madrimasd']}/emprendedores/emprendedores-casos-exito/bee", site("https://bee.org")), (f"https://{host['lanzadera']}/proyecto/cee", "<p>no link</p>")], "url string, html string")
    companies, counters = di.ingest_directories(listing, pages, rules)
    assert {(r.source, r.name_raw, r.normalized_name, r.website_domain) for r in companies.collect()} == {("catalonia", "Acme SL", "acme", "acme.com"), ("madrimasd", "Bee", "bee", "bee.org")}
    got = {r.source: (r.fetched, r.upserted, r.skipped, r.failed) for r in counters.collect()}
    assert got == {"catalonia": (2, 1, 1, 0), "madrimasd": (2, 1, 0, 1), "lanzadera": (1, 0, 1, 0), None: (5, 2, 2, 1)}
    more = rules.union(rules.filter("source = 'lanzadera'").withColumn("source", F.lit("new")))
    extra = listing.union(listing.filter("source = 'lanzadera'").withColumn("source", F.lit("new")))
    assert di.listed_entries(extra, more).filter("source = 'new'").count() == 1
