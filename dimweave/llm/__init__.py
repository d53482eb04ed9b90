"""Operators for training-data pipelines.

One module per operator; ``queries`` registers them.  Nothing outside this
package imports it.  Text functions run on the executors, so a cluster job
ships the package (``--py-files``).
"""
