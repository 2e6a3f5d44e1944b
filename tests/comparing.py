"""Comparison of results."""


def plain(frame):
    """Rows of a pandas frame as sorted tuples of text, columns by name."""
    import pandas as pd

    def show(v):
        if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and v != v):
            return "null"
        return str(int(v)) if isinstance(v, float) and v == int(v) else str(v)

    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple(map(show, row)) for row in frame.itertuples(index=False))
