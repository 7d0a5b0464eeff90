"""regstat: register statistics on Spark.

Cohort selection by diagnosis-code prefix rules, episode collapse, residence
by year from validity intervals, and distinct-person profile tables with
quality checks and a control table - all as DataFrame -> DataFrame operators.

Quick start::

    from regstat.session import local_session       # or the cluster's session
    from regstat.sources import read_sources
    from regstat.plans.run import run

    spark = local_session()
    src = read_sources(spark, "/shared/register")   # codes/ stays/ persons/ residence/ places/
    result = run(spark, src, "/shared/out")          # delivered tables + RunResult

or from a shell: ``python -m regstat --sources /shared/register --out /shared/out``.
Single steps live in ``regstat.operators`` (episodes, residence, places,
tabulate, checks); the fixed values in ``regstat.catalogue``.
"""

__version__ = "0.1.0"
