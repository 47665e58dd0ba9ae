"""The four data sets, their views and the analyses, as plain chains of operators."""
