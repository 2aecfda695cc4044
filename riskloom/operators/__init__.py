"""DataFrame operators: preparation, k-NN, SMOTE, lasso, models, evaluation,
tokenisation, log scan, lake operations and time slots."""
