"""critiq: customer-feedback quality audit, cleaning, classification, validation and
insight engine built on Spark DataFrames."""
from .plans.flow import Analysis, analyse
from .sources import read_feedback

__all__ = ["Analysis", "analyse", "read_feedback"]
__version__ = "0.1.0"
