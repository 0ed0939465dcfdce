"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from offerlens.session import build_session

HEADLINE = (
    "h1_normalize_tokens", "d1_d2_dictionary_hits", "k8_score_offers", "company_ranking",
    "f7_company_aggregate", "d6_title_duplicates", "h11_anchors", "f13_query_state",
)


#: Dearer jobs, timed beside the headline and left out of its total.
MORE = ("d9_repost_fold", "k1_offers", "g4_first_wins", "k5_j3_j6_discovery")


def main() -> None:
    import registry

    registry.load_all()
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1).count()  # JVM and session start-up is not query time

    def timed(name: str) -> float:
        start = time.perf_counter()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    names = [name for name in HEADLINE if name in registry.QUERIES]
    timed(names[0])  # the first query of a session pays for class loading and compilation
    times = {name: timed(name) for name in names}
    more = {}
    if os.environ.get("BENCH_MORE"):
        more = {name: timed(name) for name in MORE if name in registry.QUERIES}
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "more": more, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
