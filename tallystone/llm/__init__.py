"""Operations of a training-data pipeline on a table of documents. Nothing outside this folder imports it."""
