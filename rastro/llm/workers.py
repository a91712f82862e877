"""Python workers must be able to import this package."""

from pathlib import Path

ROOT = str(Path(__file__).resolve().parents[2])


def find_package(spark):
    """Put this checkout on the path of the session's Python workers.

    Executors on other machines need the package installed, or sent with ``--py-files``, as usual.
    """
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(":")
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = ":".join([ROOT, *filter(None, paths)])
