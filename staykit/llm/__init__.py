"""Operations of a training-data pipeline: counting, filtering, matching, mixing and formatting of documents."""
