"""What the training-data tests share."""

#: Texts that are hard on every operator.
ODD = (None, "", " ", "word", "two words", "x" * 3000, "  \n\t ", "Ünïcødé 中文 😀 </s>[INST]", "a\x00b\x1cc d")


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}
