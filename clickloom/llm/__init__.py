"""Operations of a training-data pipeline: classifiers, near copies, archives, tokens, mixing."""
