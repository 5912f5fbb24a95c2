"""Operations of a training-data pipeline, each over a DataFrame of documents."""
