"""Lakehouse operators for hospital and insurance data, as DataFrame functions."""
