"""DataFrame operators of the news engine."""
