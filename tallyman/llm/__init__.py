"""Operations on training corpora.  Nothing outside this package imports it."""
