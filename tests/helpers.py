from datetime import date


def rows(df, *columns):
    """The frame's rows as sorted tuples, NULLs last."""
    picked = df.select(*columns) if columns else df
    found = [tuple(row) for row in picked.collect()]
    return sorted(found, key=lambda row: [(value is None, value) for value in row])


def day(text):
    return date.fromisoformat(text)
