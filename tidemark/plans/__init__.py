"""Feeds: which operators each kind of source is made of."""
