"""Movies and ratings: load from CSV, report the most rated titles."""

from pyspark.sql import functions as F

from lakework.functions.columns import epoch_to_timestamp, to_double
from lakework.operators.relational import joined_count_and_mean, top
from lakework.sinks.files import write_report
from lakework.sinks.jdbc import write_jdbc
from lakework.sources.csv import read_csv
from lakework.sources.jdbc import jdbc_options, read_jdbc

REPORT_ROWS = 10


def typed_ratings(ratings):
    """Ratings as read from CSV with a numeric rating and a real timestamp."""
    renamed = ratings.withColumnRenamed("timestamp", "timestamp_epoch")
    return renamed.withColumns({
        "rating": to_double("rating"),
        "timestamp": epoch_to_timestamp("timestamp_epoch"),
    }).drop("timestamp_epoch")


def most_rated(movies, ratings, by=("title",)):
    """Number of ratings with a time and mean rating per title.

    Movies sharing a title count together; add the id to ``by`` to keep them apart.
    """
    return joined_count_and_mean(
        ratings, movies, "movieId", by, "timestamp", "rating", "qty_ratings", "avg_rating"
    )


def report(movies, ratings, n=REPORT_ROWS):
    return top(most_rated(movies, ratings), n, "qty_ratings", "title")


def load(spark, movies_csv, ratings_csv, save):
    """Read both files and hand each table to ``save(name, frame)``."""
    save("movies", read_csv(spark, movies_csv))
    save("ratings", typed_ratings(read_csv(spark, ratings_csv)))


def load_to_database(spark, movies_csv, ratings_csv, url, user=None, password=None, driver=None,
                     column_types=None):
    """Load both tables; ``column_types`` may give database types per table name."""
    def save(name, frame):
        options = jdbc_options(url, f"public.{name}", user, password, driver)
        write_jdbc(frame, options, column_types=(column_types or {}).get(name))

    load(spark, movies_csv, ratings_csv, save)


def report_from_database(spark, path, url, user=None, password=None, driver=None,
                         split=None, predicates=None):
    """Join and rank the database tables and write the report as one CSV file.

    ``split`` or ``predicates`` let several tasks read the ratings.
    """
    movies = read_jdbc(spark, jdbc_options(url, "public.movies", user, password, driver))
    ratings = read_jdbc(
        spark, jdbc_options(url, "public.ratings", user, password, driver), split, predicates
    )
    write_report(
        most_rated(movies, ratings), path, [F.desc("qty_ratings"), F.asc("title")], REPORT_ROWS
    )
