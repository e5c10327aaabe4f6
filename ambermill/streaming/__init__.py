"""ambermill.streaming"""
