import pandas as pd

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket string, key string, row string, fingerprint string, share string, count string, piece string, `a.b` string, `map` map<string,int>"


def odd_documents(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, other alphabets, columns named like the operators' own."""
    texts = [None, "", " \n\t ", "one", "One two", "one  two\nthree. four! five?", "é" * 40, "日本語 テキスト\n\nи ещё текст", "a b c d e f g h " * 3000, "x" * 5000, "same text here again", "same text here again", "<|endoftext|> in text"]
    rows = [(k, t, "en" if k % 3 else None, f"s{k % 2}" if k != 4 else None, None if t is None else len(t), "b", "k", "r", "f", "h", "c", "p", "d", {"x": 1}) for k, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, "no id at all", *[None] * 12), (None,) * 14]
    return spark.createDataFrame(rows, SCHEMA)


def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def rows_of(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=repr)


def frame(df) -> pd.DataFrame:
    return df.toPandas()
