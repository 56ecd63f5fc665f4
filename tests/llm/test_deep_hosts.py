"""Listed hosts of more labels than a host name can have are blocked too."""

import pytest

from capturebase.llm import url_cascade


@pytest.mark.parametrize("rules", [[], [("allow", "y.org", "/ok")]])
@pytest.mark.parametrize("shallow", [[], ["bad.net"]])
def test_listed_hosts_of_many_labels(spark, rules, shallow):
    deep = "a." * 200 + "y.org"
    urls = [f"http://{deep}/x", f"http://B.{deep.upper()}/x", f"http://{deep[2:]}/x", f"http://b{deep}/x", "http://y.org/", "http://www.bad.net/", None, f"http://{deep}/ok", f"http://{deep}/x"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    out = url_cascade.filter_urls(pages, rules, spark.createDataFrame([(h,) for h in [deep, *shallow]], "host string"))
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    got = {r.page_id: r.verdict for r in out.collect()}
    want = [True, True, False, False, False, bool(shallow), False, not rules, True]
    assert got == {i: "block" if x else "allow" for i, x in enumerate(want)}
