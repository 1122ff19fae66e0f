"""panelscope: exposure analytics for entity x period x unit panels on Spark."""

__version__ = "0.1.0"
