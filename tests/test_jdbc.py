"""Options only: no database is started for tests."""

import pytest

from lakework.plans import movies
from lakework.sinks import jdbc as sink
from lakework.sources import jdbc as source


class Recorder:
    """Stands for a reader or writer and notes what it is told."""

    def __init__(self):
        self.told, self.calls = {}, []

    def format(self, name):
        self.told["format"] = name
        return self

    def option(self, name, value):
        self.told[name] = value
        return self

    def options(self, **options):
        self.told.update(options)
        return self

    def mode(self, mode):
        self.told["mode"] = mode
        return self

    def load(self):
        return self

    def save(self):
        self.calls.append("save")

    def jdbc(self, url, table, predicates, properties):
        self.told.update(url=url, dbtable=table, predicates=predicates, **properties)
        return self


class Session:
    def __init__(self):
        self.read = Recorder()


class Frame:
    def __init__(self):
        self.write = Recorder()


OPTIONS = source.jdbc_options("jdbc:postgresql://db/lake", "public.movies", "u", "p")


def test_unset_options_are_left_out():
    assert OPTIONS == {
        "url": "jdbc:postgresql://db/lake", "dbtable": "public.movies", "user": "u", "password": "p"
    }


def test_split_read():
    session = Session()
    source.read_jdbc(session, OPTIONS, source.split_options("id", 0, 1000, 4))
    told = session.read.told
    assert told["format"] == "jdbc" and told["numPartitions"] == 4 and told["partitionColumn"] == "id"
    with pytest.raises(ValueError):
        source.split_options("id", 0, 1, 0)


def test_predicates_cover_null_keys_once():
    slices = source.hash_predicates("movieId", 3)
    assert len(slices) == 3 and "is null" in slices[0]
    assert not any("is null" in s for s in slices[1:])
    session = Session()
    source.read_jdbc(session, OPTIONS, predicates=slices)
    assert session.read.told["predicates"] == slices and session.read.told["user"] == "u"


def test_overwrite():
    frame = Frame()
    sink.write_jdbc(frame, OPTIONS, column_types="title VARCHAR(200)")
    told = frame.write.told
    assert told["mode"] == "overwrite" and told["createTableColumnTypes"] == "title VARCHAR(200)"
    assert "numPartitions" not in told and frame.write.calls == ["save"]


def test_movies_tables_are_named_and_typed(monkeypatch):
    saved = {}
    monkeypatch.setattr(movies, "write_jdbc", lambda f, o, column_types: saved.update({o["dbtable"]: column_types}))
    monkeypatch.setattr(movies, "load", lambda spark, m, r, save: [save("movies", None), save("ratings", None)])
    movies.load_to_database(None, "m.csv", "r.csv", "jdbc:x", column_types={"movies": "title VARCHAR(900)"})
    assert saved == {"public.movies": "title VARCHAR(900)", "public.ratings": None}
