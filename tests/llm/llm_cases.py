"""Shared by the tests of this folder."""

SF = "/root/testdata/sf0.001"


def plain(df):
    """The rows as Python values."""
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
