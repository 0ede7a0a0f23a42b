"""Operations of a training-data pipeline over text tables. Nothing else in tidemark imports this subpackage."""
