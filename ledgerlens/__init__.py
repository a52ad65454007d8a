"""ledgerlens: retail sales analytics expressed as lazy Spark DataFrame operators.

Every public operator is a ``DataFrame -> DataFrame`` function (usable with
``df.transform``) or a builder that returns a DataFrame.  Nothing in the library
collects rows to the driver; the driver-side actions are listed in the README.

Entry points:

    build_session, cluster_conf, checkpoint_root   (ledgerlens.session)
    sales_fact                                      (ledgerlens.sources.star)
    read_sales_csv                                  (ledgerlens.sources.csv)
    questions                                       (ledgerlens.plans.questions)
    run_pipeline                                    (ledgerlens.streaming.pipeline)
"""

from ledgerlens.session import build_session, checkpoint_root, cluster_conf

__all__ = ["build_session", "checkpoint_root", "cluster_conf"]
