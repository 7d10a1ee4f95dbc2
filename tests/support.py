"""What several test files of the library share; a plain module, for every folder of tests has a conftest of its own."""

SMALL = "/root/testdata/sf0.001"


def rows(df, *cols):
    out = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in out.collect()), key=repr)
