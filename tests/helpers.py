"""What several test modules share."""


def tuples(df, *columns):
    """Rows as a sorted list of tuples, nulls first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()),
                  key=lambda r: tuple((v is not None, v if v is not None else 0) for v in r))
