"""The registered queries of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from beaconlake.llm.centroids import op11_centroids
from beaconlake.llm.decontamination import op6_decontamination
from beaconlake.llm.html_regions import op5_html_regions
from beaconlake.llm.licenses import op3_license_scan
from beaconlake.llm.mixing import op9_mixing
from beaconlake.llm.near_dedup import op8_near_dedup
from beaconlake.llm.pseudo_likelihood import op1_pseudo_likelihood
from beaconlake.llm.radix_trie import op13_prefix_trie
from beaconlake.llm.ranking_classifier import op4_ranking_classifier
from beaconlake.llm.secrets import op12_secret_scan
from beaconlake.llm.suffix_rules import op2_suffix_rules
from beaconlake.llm.url_filters import op10_url_filters
from beaconlake.llm.warc_zip import op7_warc_zip
from beaconlake.session import configure

Query = Callable[[SparkSession, str], DataFrame]


def _configured(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


QUERIES: dict[str, Query] = {
    query.__name__: _configured(query)
    for query in (
        op1_pseudo_likelihood, op2_suffix_rules, op3_license_scan, op4_ranking_classifier, op5_html_regions,
        op6_decontamination, op7_warc_zip, op8_near_dedup, op9_mixing, op10_url_filters, op11_centroids, op12_secret_scan, op13_prefix_trie,
    )
}
