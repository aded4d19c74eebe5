"""Readers for rate files, trade exports and exchange JSON; result sinks."""
