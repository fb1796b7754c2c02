"""Call-to-payment analytics expressed as PySpark DataFrame functions."""

from callpay.config import PipelineConfig

__all__ = ["PipelineConfig"]
