"""DataFrame to DataFrame operators on canonical events, feature tables and predictions."""
