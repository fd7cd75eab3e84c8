def rows(df):
    """Rows as tuples, in the order they come."""
    return [tuple(r) for r in df.collect()]


def bag(df):
    """Rows as a sorted list, for comparing without order."""
    return sorted(rows(df), key=repr)
