"""Training-data operators: tokenizing, chat formatting, classifiers, search, deduplication, rules and mixing."""
